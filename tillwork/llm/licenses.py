"""License scans: an exact containment join of all text blocks with license templates."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillwork.llm.common import texts
from tillwork.llm.license_texts import FAMILIES, TEMPLATES

# The phrases of the base scan and their labels.
PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
# Fixed values end.

#: Bytes of words (letters and digits in lower case, everything beyond ASCII) stay, others become a space.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_WORDS).split()


def places(words: list[bytes], phrase: list[bytes]) -> list[int]:
    """Where the phrase's words stand one after another."""
    anchor = max(range(len(phrase)), key=lambda k: len(phrase[k]) * (phrase[k] not in (b"license", b"under", b"version")))
    found, at, n = [], -1, words.count(phrase[anchor])
    for _ in range(n):
        at = words.index(phrase[anchor], at + 1)
        start = at - anchor
        if start >= 0 and words[start:start + len(phrase)] == phrase:
            found.append(start)
    return found


@dataclass(frozen=True)
class Template:
    number: int
    label: str
    tokens: tuple[int, ...]  # in the global order, rarest first
    need: int  # tokens that a block must share
    width: int  # words of a block


@dataclass(frozen=True)
class Block:
    """A stretch of text in which every block of the template's width, or the whole text, meets the threshold."""
    label: str
    template: int
    start: int
    end: int
    containment: float  # the best of these blocks
    leading: bool = True  # no variant of the same family explains overlapping words better


class Index:
    """Templates by the tokens of their prefixes, in the order of the tokens' frequency in the corpus."""

    def __init__(self, templates: list[tuple[str, str]], frequency: dict[bytes, int], threshold: float,
                 families: list[set[str]]):
        sets = [(label, len(words_of(text)), set(words_of(text))) for label, text in templates]
        order = sorted({t for _, _, ts in sets for t in ts}, key=lambda t: (frequency.get(t, 0), t))
        self.rank = {t: i for i, t in enumerate(order)}
        self.family = {label: k for k, labels in enumerate(families) for label in labels}
        #: token -> (template, place of the token in it); a block that shares enough has one of these
        self.prefix: dict[bytes, list[tuple[Template, int]]] = {}
        for number, (label, n, ts) in enumerate(sets):
            # as many words may stand between a block's as may be missing
            t = Template(number, label, tuple(sorted(self.rank[w] for w in ts)), math.ceil(threshold * len(ts) - 1e-9),
                         n + math.floor((1 - threshold) * n + 1e-9))
            for i in range(len(t.tokens) - t.need + 1):
                self.prefix.setdefault(order[t.tokens[i]], []).append((t, i))

    def blocks(self, words: list[bytes]) -> list[Block]:
        """All stretches of blocks that meet a template's threshold, for every template."""
        prefix, rank = self.prefix, self.rank
        spans: dict[Template, list[list[int]]] = {}  # where blocks hold a token of the prefix: [first, end, rarest one's place]
        for i, w in enumerate(words):
            for t, place in prefix.get(w, ()):
                known = spans.setdefault(t, [])
                start, end = max(0, i - t.width + 1), min(len(words), i + t.width)
                if known and start < known[-1][1]:
                    known[-1][1:] = [end, min(place, known[-1][2])]
                else:
                    known.append([start, end, place])
        found: list[Block] = []
        for t, known in spans.items():
            for start, end, place in known:
                ranks = [rank.get(w, -1) for w in words[start:end]]
                # length filter; position filter: what precedes the first shared token is not shared
                if end - start < t.need or min(len(t.tokens) - place, len({r for r in ranks if r >= t.tokens[place]})) < t.need:
                    continue
                found += self._stretches(t, start, ranks)
        return self._lead(sorted(found, key=lambda x: (x.start, x.end, x.template)))

    @staticmethod
    def _stretches(t: Template, first: int, ranks: list[int]) -> Iterator[Block]:
        """Counts the template's tokens in block after block; blocks at the threshold side by side are one stretch."""
        mine, inside, shared = set(t.tokens), Counter(), 0
        start = best = 0
        for at, r in enumerate([*ranks, -1]):
            gone = at - t.width  # ``shared`` is that of the block which ends before ``at``
            if gone >= 0 or at == len(ranks):
                begin = max(gone, 0)
                if shared >= t.need:
                    start, best = (begin, shared) if not best else (start, max(best, shared))
                if best and (shared < t.need or at == len(ranks)):
                    end = at if shared >= t.need else at - 1
                    yield Block(t.label, t.number, first + start, first + end, best / len(t.tokens))
                    best = 0
            if gone >= 0 and ranks[gone] in mine:
                inside[ranks[gone]] -= 1
                shared -= inside[ranks[gone]] == 0
            if r in mine:
                inside[r] += 1
                shared += inside[r] == 1

    def _lead(self, found: list[Block]) -> list[Block]:
        """Marks those that a variant of the same family, with more of its template, overlaps; ``found`` is in order."""
        behind: set[int] = set()
        open_: list[int] = []  # those of families that reach beyond the current start
        for k, x in enumerate(found):
            if (mine := self.family.get(x.label)) is None:
                continue
            open_ = [j for j in open_ if found[j].end > x.start]
            for j in open_:
                y = found[j]
                if y.label != x.label and self.family[y.label] == mine and y.containment != x.containment:
                    behind.add(j if y.containment < x.containment else k)
            open_.append(k)
        return [replace(x, leading=False) if k in behind else x for k, x in enumerate(found)]


def _frequencies(docs: DataFrame, tokens: set[bytes]) -> dict[bytes, int]:
    """In how many documents each template token occurs, over all of them."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in texts(batch):
                seen.update(tokens.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array([t.decode() for t in seen], pa.string()),
                                          pa.array(list(seen.values()), pa.int64())], names=["token", "n"])

    counts = docs.select("text").mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r["token"].encode(): r["n"] for r in counts.collect()}  # a row per template token at most


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, threshold: float = 0.85,
         families: list[set[str]] | None = None) -> DataFrame:
    """doc_id, n_words, ``base`` (places of the fixed phrases) and ``blocks`` (what the join finds).

    A text block is as long as the template it is held against, and the share 1 - ``threshold``
    of that longer; one starts at every word (a shorter text is one block). It matches if
    it has at least ``threshold`` of the template's distinct words. Candidates come from prefixes
    in the global order of the words' document counts, then pass the length and the position
    filter, then are counted: every block at the threshold is found, for every template. Blocks
    that follow each other are given as one stretch. ``leading`` is false only where a variant of
    the same declared family has more of its template in overlapping words. Whole texts; null is
    empty; repeated and null ids are rows like others.
    """
    templates = templates or TEMPLATES
    index = Index(templates, _frequencies(docs, {w for _, t in templates for w in words_of(t)}), threshold,
                  FAMILIES if families is None else families)
    phrases = {label: words_of(text) for label, text in PHRASES.items()}
    kind = dict(docs.dtypes)["doc_id"]
    base_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
    block_type = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                     ("containment", pa.float64()), ("leading", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, base, blocks = [], [], []
            for text in texts(batch):
                words = words_of(text)
                n.append(len(words))
                base.append([{"label": label, "start": at} for label, p in phrases.items() for at in places(words, p)])
                blocks.append([{f: getattr(x, f) for f in ("label", "start", "end", "containment", "leading")}
                               for x in index.blocks(words)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(base, base_type), pa.array(blocks, block_type)],
                names=["doc_id", "n_words", "base", "blocks"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, base array<struct<label string, start long>>, "
             "blocks array<struct<label string, start long, end long, containment double, leading boolean>>")


def digest(found: DataFrame) -> DataFrame:
    """One row per document of ``scan``: counts, first and last place, labels, and a score.

    Labels come from leading blocks. The score is the best containment of a block, 1 where a fixed phrase stands, else 0.
    """
    starts = F.transform("base", lambda x: x["start"])
    base = F.array_distinct(F.transform("base", lambda x: x["label"]))
    more = F.transform(F.filter("blocks", lambda x: x["leading"]), lambda x: x["label"])
    best = F.coalesce(F.array_max(F.transform("blocks", lambda x: x["containment"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), F.concat_ws(",", F.array_sort(base)).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union(base, more))).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(best).alias("score"))
