"""The prefix trie against a plain one that groups all prefixes as tuples."""
import hashlib
import zlib

import numpy as np
import pytest

from tillwork.llm import common, trie

KIND = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def turn_key(row):
    _, turn, role, text = row
    role, text = role or "", text or ""
    return turn is not None, turn or 0, hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def plain(rows):
    convs = {}
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], turn_key(r))):
        convs.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, [])
        leaves[node] = sum(leaves[k] for k in kids) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[k] for k in kids)
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else -10 ** 9, len(m), len(children.get(node, [])), leaves[node],
                   saved[node], sha(",".join(str(c) for c in sorted(m) if len(built[c]) == len(node)))) for node, m in members.items())


def told(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-10 ** 9 if x is None else x for x in r) for r in df.select(*names).collect())


def made(seed=3, copies=300):
    rng = np.random.default_rng(seed)
    rows, say = [], lambda: "".join(rng.choice(list("abé"), 2))
    for c in range(0, 400):
        rows += [(c, t, ["user", "assistant"][t % 2], say()) for t in range(rng.integers(1, 12))]
    for c in range(1000, 1000 + copies):  # copies, and a first turn that many share
        rows += [(c, 0, "system", "be kind"), (c, 1, "user", "hello")]
    for c in range(2000, 2000 + copies):
        rows += [(c, 0, "system", "be kind"), (c, 1, "user", f"hello {c}"), (c, 2, "assistant", say())]
    rows += [(c, t, "user", f"long {t}") for c in (3000, 3001, 3003) for t in range(500)]
    return rows


def odd():
    return [(None, 0, "user", "lost"), (5, None, None, None), (5, None, "user", "x"), (5, 1, "user", "x"), (5, 1, "user", "x"),
            (6, 0, "a:b", ""), (7, 0, "a", "b"), (8, 0, "", "ab"), (9, 0, None, "ab"), (11, 3, "user", "y" * 100_000), (12, 0, "ab", None),
            (13, 2, "user", "t"), (13, 2, "assistant", "t"), (-7, 0, "user", "minus")]


@pytest.mark.parametrize("rows", [made(), odd(), odd()[:1], []], ids=["made", "odd", "lost", "none"])
def test_trie(spark, rows):
    df = spark.createDataFrame(rows, KIND)
    rows = [r for r in rows if (r[0] or 0) >= 0]
    got = told(trie.nodes(df.where("conv_id IS NULL OR conv_id >= 0")))
    assert got == (plain(rows) if any(r[0] is not None for r in rows) else [])


def test_extra_columns_and_a_full_sketch(spark):
    """A sketch that is far too small proves nothing alone; the rows stay the same."""
    from pyspark.sql import functions as F
    rows = made(5, 20)
    wide = spark.createDataFrame(rows, KIND).withColumns({n: F.lit("x") for n in ("a", "b", "depth", "_n", "_at", "len", "conv", "digest")})
    want = plain(rows)
    assert told(trie.nodes(wide)) == want

    found = trie.prefixes(trie.rebuild(wide))
    seen = trie.sketch(found)
    assert trie.screen(found, seen).where("alone").count() > 100
    ones = zlib.compress(b"\xff" * (trie._BLOCK // 8))
    full = trie.Sketch(seen.width, {k: (ones, ones) for k in range(4 * seen.width // trie._BLOCK)})
    assert not trie.screen(found, full).where("alone").count()
    original, trie.sketch = trie.sketch, lambda df, most: full
    try:
        assert told(trie.nodes(wide)) == want
    finally:
        trie.sketch = original


def test_negative_ids_have_their_base_towards_zero(spark):
    got = told(trie.nodes(spark.createDataFrame([r for r in odd() if r[0] == -7], KIND)))
    assert [r[:2] for r in got] in ([(-7, 0), (-7, 1)], [(-7, 0)])


def test_sketch_never_calls_a_shared_prefix_alone(spark):
    found = trie.prefixes(trie.rebuild(spark.createDataFrame(made(9), KIND)))
    for cells in (1 << 16, 1 << 18):
        flagged = trie.screen(found, trie.sketch(found, cells))
        times = flagged.where("depth > 0").groupBy("a", "b").agg({"alone": "max", "*": "count"})
        assert not times.where("`count(1)` > 1 AND `max(alone)`").count()


def test_digests_of_members_over_many_parts(spark):
    ends = spark.range(5000).selectExpr("id % 3 AS a", "0L AS b", "id AS conv").repartition(7)
    got = {r["a"]: r["ends_sha256"] for r in trie.member_digests(ends, chars=500).collect()}
    assert got == {k: sha(",".join(str(i) for i in range(k, 5000, 3))) for k in range(3)}


def test_running_sums_cut_long_keys(spark):
    rows = spark.range(1000).selectExpr("id % 2 AS k", "id div 2 AS p", "1L AS v")
    got = common.running_sums(rows, "k", "p", {"s": rows["v"]}, chunk=16).where("s <> p + 1").count()
    assert got == 0


def test_a_whole_table(spark):
    table = common.table(spark, "/root/testdata/sf0.01", "conversations")
    assert told(trie.nodes(table)) == plain([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
