"""The template language, and conversations formatted and read back."""
import hashlib

import pytest
from hypothesis import given, settings, strategies as st

from tests.llm.test_trie import turn_key
from tillwork.llm import chat, common, templates as T

KIND = "conv_id long, turn long, role string, text string"


def run(source, **names):
    return T.compile_template(source, chat.FILTERS)(**names)


@pytest.mark.parametrize("source, want", [
    ("a{{ 1 + 2 * 3 }}b", "a7b"), ("{{ 'x' ~ 1 ~ none }}", "x1"), ("{{ -(2 - 5) // 2 }}", "1"), ("{{ x.y[1] }}", "q"),
    ("{{ 'a' if x.y else 'b' }}", "a"), ("{% if x.z is defined %}1{% elif 'p' in x.y %}2{% else %}3{% endif %}", "2"),
    ("{% if not x.y and 1 / 1 %}{% endif %}", None), ("{% for i in x.y %}{{ loop.index0 }}{{ i }}{% if not loop.last %},{% endif %}{% endfor %}", "0p,1q"),
    ("  {%- set n = 'v' -%}  [{{ n|upper }}]", "[V]"), ("{# no #}{{ x.none is none }}", "True"), ("{{ missing|default('d') }}", "d"),
    ("{% for i in x.y %}{% set k = i %}{% endfor %}{{ k }}", ""), ("{{ [1, 2][5] is none }}", "True"), ("{{ 2 <= 2 and 'a' not in 'bc' }}", "True"),
    ("{{ true or x.q.q }}", "True"), ("{{ '\\n' }}", "\n"), ("{{ [1, 'a'] | length }}", "2"), ("{{ 7 % 4 - 1 }}", "2")])
def test_language(source, want):
    if want is None:
        with pytest.raises(T.TemplateError):
            run(source, x={"y": ["p", "q"]})
    else:
        assert run(source, x={"y": ["p", "q"]})[0] == want


@pytest.mark.parametrize("source", ["{{ x.__class__ }}", "{{ x.y() }}", "{{ 'a' * 9 }}", "{{ x|open }}", "{% import os %}", "{% if 1 %}", "{{ 1 + }}",
                                    "{{ 'a'.upper }}", "{% for i in 5 %}{% endfor %}", "{{ (1 }}", "{% set 1 = 2 %}", "{{ $ }}"])
def test_sandbox_and_faults(source):
    with pytest.raises(T.TemplateError):
        assert run(source, x={"y": "t"}) == ("", [])
        raise T.TemplateError("an entry that is not there reads as none")


def test_constants_fold():
    tree = T.parse("a{{ 1 + 1 }}{% if 2 > 1 %}b{{ 'c' ~ 'd' }}{% else %}{{ x }}{% endif %}{% if false %}{{ x }}{% endif %}", chat.FILTERS)
    assert tree == (T.Text("a2bcd"),)


def test_generation_marks():
    text, marks = run("{% for m in messages %}<{% generation %}{{ m }}{% endgeneration %}>{% endfor %}", messages=["ab", "", "ñ"])
    assert text == "<ab><><ñ>" and [text[a:b] for a, b in marks] == ["ab", "", "ñ"]


piece = st.one_of(st.sampled_from([*chat.CONTROLS, "\\", "[", "<", "]", " ", "/INST]", "s>"]), st.text(max_size=4))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), piece), st.lists(piece, max_size=6).map("".join)), max_size=6))
def test_turns_come_back(turns):
    text, marks = run(chat.TEMPLATE, messages=[{"role": r, "text": t} for r, t in turns])
    assert chat.read_back(text) == turns
    assert [chat.unguard(text[a:b]) for a, b in marks] == [t for r, t in turns if r == "assistant"]
    assert all(c not in chat.guard(t) for _, t in turns for c in chat.CONTROLS)


def plain(rows):
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    out = []
    for c in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=turn_key)]
        learned = "".join(t for r, t in turns if r == "assistant")
        size = 3 + sum({"user": 15, "assistant": 4}.get(r, 17 + len(chat.guard(r))) + len(chat.guard(t)) for r, t in turns)
        out.append((c, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned), size))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def told(df):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def odd():
    return [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, None, None, None), (2, 0, "assistant", ""), (3, 0, "assistant", "same"),
            (3, 0, "assistant", "same"), (3, 0, "user", "tie"), (None, 0, "user", "lost"), (None, 1, "assistant", "too"),
            (4, 0, "[ROLE]", "</s>" * 3), (5, 0, "assistant", "long " * 50_000), (6, 0, "tool", "\ud83d\ude00 ñ".encode("utf-16", "surrogatepass").decode("utf-16"))]


def test_conversations(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(odd(), KIND).withColumns({n: F.lit("x") for n in ("formatted", "loss", "_turn", "_digest", "row")})
    assert told(chat.digest(chat.render(df, chars=100))) == plain(odd())
    assert told(chat.digest(chat.render(df.limit(0)))) == []


def test_the_probe(spark):
    row, = chat.render(chat.probe(spark)).collect()
    assert row["formatted"] == "<s>[INST] <\\/s>[\\INST] ok [\\/INST] [/INST]<\\/s>[\\INST] ok [\\/INST]</s>"
    assert told(chat.digest(chat.render(chat.probe(spark)))) == plain([tuple(r) for r in chat.probe(spark).collect()])


def test_a_whole_table(spark):
    table = common.table(spark, "/root/testdata/sf0.01", "conversations").select("conv_id", "turn", "role", "text")
    assert told(chat.digest(chat.render(table))) == plain([tuple(r) for r in table.collect()])
