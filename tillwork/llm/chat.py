"""Chat formatting: conversations rendered by a compiled template, and read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwork.llm.common import turn_digest
from tillwork.llm.templates import compile_template

#: What marks turns in a formatted conversation; no text contains one of them once it is guarded.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]")

#: Users between [INST] marks, assistants up to </s>, any other role by its name.
TEMPLATE = """
{%- set begin = '<' ~ 's>' %}
{%- set end = '</' ~ 's>' -%}
{{ begin }}
{%- for m in messages -%}
  {%- if m.role == 'user' -%}
    {{ '[INST] ' }}{{ m.text | guard }}{{ ' [/INST]' }}
  {%- elif m.role == 'assistant' -%}
    {% generation %}{{ m.text | guard }}{% endgeneration %}{{ end }}
  {%- else -%}
    {{ '[ROLE]' ~ (m.role | guard) ~ '[/ROLE]' }}{{ m.text | guard }}{{ end }}
  {%- endif -%}
{%- endfor -%}
"""

_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROLS))
_TURN = re.compile(r"\[INST\] (.*?) \[/INST\]|\[ROLE\](.*?)\[/ROLE\](.*?)</s>|(.*?)</s>", re.DOTALL)


def guard(text: str) -> str:
    """Backslashes doubled, and one put behind the first character of every control string."""
    return _CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unguard(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


#: All that templates may apply to a value.
FILTERS = {"guard": guard, "trim": str.strip, "upper": str.upper, "lower": str.lower, "length": len,
           "default": lambda value, other: other if value is None else value}


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of all turns of a conversation formatted by ``TEMPLATE``."""
    at, turns = len(CONTROLS[0]), []
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        user, role, text, answer = found.groups()
        if user is not None:
            turns.append(("user", unguard(user)))
        elif role is not None:
            turns.append((unguard(role), unguard(text)))
        else:
            turns.append(("assistant", unguard(answer)))
        at = found.end()
    return turns


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -1, whose texts are made of control strings."""
    said = "</s>[INST] ok [/INST]"
    return spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)],
                                 "conv_id long, turn long, role string, text string")


def render(conversations: DataFrame, template: str = TEMPLATE, chars: int = 4_000_000) -> DataFrame:
    """One row per conversation: conv_id, ``formatted``, and ``loss``, the spans a model is to learn.

    Turns go by turn, null first, then by the digest of role and text. A null role or text is
    empty; rows without conv_id are one conversation without id; repeated rows are turns of their
    own; no rows give no rows; other columns are not read. Spans count code points. A task holds
    one conversation at a time and hands results on whenever they have ``chars`` characters.
    """
    names = ["conv_id", "role", "text"]
    turns = conversations.select("conv_id", F.col("turn").alias("_turn"), turn_digest().alias("_digest"),
                                 F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = turns.repartition("conv_id").sortWithinPartitions("conv_id", F.col("_turn").asc_nulls_first(), "_digest")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[batch.column(n).to_pylist() for n in names], strict=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, done, size = compile_template(template, FILTERS), [], 0

        def packed() -> pa.RecordBatch:
            ids, texts, spans = zip(*done) if done else ((), (), ())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            spans = [[{"start": a, "end": b} for a, b in s] for s in spans]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(spans, kind)],
                                              names=["conv_id", "formatted", "loss"])

        for conv_id, group in groupby(rows(batches), key=lambda r: r[0]):
            text, marks = run(messages=[{"role": role, "text": said} for _, role, said in group])
            done.append((conv_id, text, marks))
            size += len(text)
            if size >= chars:
                yield packed()
                done, size = [], 0
        yield packed()

    return grouped.select(*names).mapInArrow(work, "conv_id long, formatted string, loss array<struct<start: long, end: long>>")


def digest(rendered: DataFrame) -> DataFrame:
    """What is read back from formatted conversations: turns, and the text under the loss spans."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for batch in batches:
            n_turns, turns, chars, loss, sizes = [], [], [], [], []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss").to_pylist(), strict=True):
                found = read_back(text)
                learned = "".join(unguard(text[s["start"]:s["end"]]) for s in spans)
                n_turns.append(len(found))
                turns.append(sha("".join(f"{role}\n{said}\n" for role, said in found)))
                chars.append(len(learned))
                loss.append(sha(learned))
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(n_turns, pa.int64()), pa.array(turns, pa.string()),
                 pa.array(chars, pa.int64()), pa.array(loss, pa.string()), pa.array(sizes, pa.int64())],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return rendered.mapInArrow(work, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                     "loss_sha256 string, formatted_chars long")
