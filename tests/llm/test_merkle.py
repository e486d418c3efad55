"""The manifest against a plain tree that is built and folded in one place."""
import hashlib
import zlib

import pytest

from tests.llm.conftest import odd_rows
from tillwork.llm import merkle


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    return digest(*map(field, (doc_id, source, lang, None if n_chars is None else n_chars + more, text)))


def tree(nodes, k):
    """The root, and for each node its runs up to the root with its slots."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            paths[i].append((nodes[place // k * k:place // k * k + k], place % k))
            at[i] = place // k
        nodes = [digest(*nodes[j:j + k]) for j in range(0, len(nodes), k)]
    return nodes[0], paths


def plain(rows, k=2):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    inside = {}
    for lang in langs:
        here = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        inside[lang] = (here, *tree([leaf(r) for r in here], k))
    out = []
    root, above = tree([inside[lang][1] for lang in langs], k) if langs else (None, [])
    for lang, up in zip(langs, above):
        here, subroot, paths = inside[lang]
        for row, path in zip(here, paths):
            proof = digest(*[x for run, slot in path + up for j, x in enumerate(run) if j != slot])
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[4] is not None
            folded = leaf(row, int(hit))
            for run, slot in path + up:
                folded = digest(*[folded if j == slot else x for j, x in enumerate(run)])
            out.append((row[0], leaf(row), subroot, root, proof, folded, folded == root))
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


def told(df):
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=lambda r: [(x is not None, x) for x in r])


@pytest.mark.parametrize("arity", [2, 3, 5])
def test_manifest_of_odd_rows(odd_wide, arity):
    rows = odd_rows()
    got = told(merkle.manifest(odd_wide, arity))
    assert got == plain(rows, arity)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize("rows", [
    [], [(7, "alone", "en", "s", 5)], [(7, "a", "en", "s", 5), (8, "b", "de", "s", None)],
    [(None, "same", None, None, 2 ** 63 - 1)] * 5, [(i, f"t{i}", "en", "s", 2 ** 63 - 1) for i in range(33)]],
    ids=["none", "lone", "two trees", "null ids", "a run of one"])
def test_small_manifests(spark, rows):
    assert told(merkle.manifest(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))) == plain(rows)


def test_one_change_fails_one_row_only(spark):
    rows = [(i, f"text {i}", ["en", "de"][i % 2], "s", 6) for i in range(50)]
    bad = {r[0] for r in told(merkle.manifest(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")))
           if not r[-1]}
    assert bad == {i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 0}
