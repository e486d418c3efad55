"""Quality rules: divergence of a document's character and word histograms from its language's."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillwork.llm.common import LOWER, settle, texts

WINDOW = 8
_WHITE = b" \t\n\r\x0b\x0c"
_MIX = np.random.default_rng(8).integers(1, 2 ** 63, WINDOW, dtype=np.uint64) | np.uint64(1)


def _class_of(b: int) -> int:
    c = chr(b)
    if b > 127:
        return 6 if b >= 0xC0 else 7  # the first byte of a character beyond ASCII; its further bytes
    for k, has in enumerate((c.islower(), c.isupper(), c.isdigit(), c.isspace(), c in ".,;:?!'\"()-")):
        if has:
            return k
    return 5


#: Bytes by class: lower, upper, digit, white space, punctuation, symbol, beyond ASCII.
_CLASS = np.zeros((256, 7))
for _b in range(256):
    if _class_of(_b) < 7:
        _CLASS[_b, _class_of(_b)] = 1


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of 8 words which the text has twice or more."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    # equal windows have equal sums; only where two sums are equal are the windows themselves compared
    plus = ids.astype(np.uint64) + np.uint64(1)
    sums = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        sums += plus[k:k + n] * _MIX[k]
    ordered = np.sort(sums)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0
    span, names = 1, ids
    while span < WINDOW:
        pairs = names[:-span] * (int(names.max()) + 1) + names[span:]
        names = np.unique(pairs, return_inverse=True)[1]
        span *= 2
    again = np.bincount(names)[names] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(again), 1)
    np.add.at(cover, np.flatnonzero(again) + WINDOW, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


@dataclass
class Measures:
    """What the rules look at in one text."""
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    lower: list[bytes]
    classes: np.ndarray

    @classmethod
    def of(cls, text: str) -> Measures:
        raw = text.encode()
        words = raw.split()
        white = sum(raw.count(w) for w in _WHITE)
        lines = [line for line in raw.split(b"\n") if line.strip(_WHITE)]
        return cls(len(words), len(text) - white, sum(raw.count(s) for s in b"#*$%&|<>"),
                   len(lines) - len(set(lines)), repeated_words(words), raw.translate(LOWER).split(),
                   np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASS)

    @property
    def base_failed(self) -> bool:
        return self.n_words < 20 or 100 * self.n_repeat_words > 30 * self.n_words


@dataclass(frozen=True)
class References:
    """Per language the shares of character classes, and of common words with all others together."""
    langs: list[str]
    classes: np.ndarray  # language x class
    words: list[dict[bytes, int]]  # word -> place in ``shares``
    shares: list[np.ndarray]


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of rows of shares: 0 for equal ones, 1 for those with nothing in common."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        part = lambda x: np.where(x > 0, x * np.log2(x / m), 0).sum(axis=-1)
        return np.sqrt(np.clip((part(p) + part(q)) / 2, 0, 1))


def references(docs: DataFrame, common: float = 0.002) -> References:
    """Class and word shares of each language, over all its documents that pass the base rules.

    A word is common if it makes up at least the share ``common`` of its language's words, so
    a language has at most 1 / common of them. Every language with such a document gets a
    reference. Counts are summed in the tasks, then by Spark; a task forgets its word counts
    whenever they reach a quarter million and sends them on.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def out() -> pa.RecordBatch:
            rows = [(lang, key, n) for lang, c in seen.items() for key, n in c.items()]
            seen.clear()
            lang, key, n = zip(*rows, strict=True) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(key, pa.binary()),
                                               pa.array(n, pa.int64())], names=["lang", "key", "n"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch), strict=True):
                m = Measures.of(text)
                if lang is None or m.base_failed:
                    continue
                c = seen.setdefault(lang, Counter())
                c.update(m.lower)
                # words hold no white space, so these keys are apart from them
                c.update({b" %d" % k: int(x) for k, x in enumerate(m.classes) if x})
                c[b" words"] += m.n_words
                c[b" documents"] += 1
                if sum(map(len, seen.values())) > 250_000:
                    yield out()
        yield out()

    counts = (docs.select("lang", "text").mapInArrow(count, "lang string, key binary, n long")
              .groupBy("lang", "key").agg(F.sum("n").alias("n")))
    counts = settle(counts, "quality-counts")
    is_total = F.substring("key", 1, 1) == F.lit(b" ")
    totals = counts.where(is_total)
    top = totals.where(F.col("key") == F.lit(b" documents"))
    langs = sorted(r["lang"] for r in top.collect())
    words = totals.where(F.col("key") == F.lit(b" words")).select("lang", F.col("n").alias("all"))
    frequent = (counts.where(~is_total).join(words.where(F.col("lang").isin(langs)), "lang")
                .where(F.col("n") >= common * F.col("all")).select("lang", "key", (F.col("n") / F.col("all")).alias("p")))
    found = {lang: {} for lang in langs}
    for lang, key, p in frequent.collect():
        found[lang][bytes(key)] = p
    classes = np.zeros((len(langs), 7))
    for lang, key, n in totals.where(F.col("lang").isin(langs)).collect():
        if (k := bytes(key)[1:]).isdigit():
            classes[langs.index(lang), int(k)] = n
    keys = [sorted(found[lang]) for lang in langs]
    shares = [np.array([*(found[lang][k] for k in ks), max(0.0, 1 - sum(found[lang].values()))])
              for lang, ks in zip(langs, keys, strict=True)]
    return References(langs, classes / np.maximum(classes.sum(axis=1, keepdims=True), 1),
                      [{k: i for i, k in enumerate(ks)} for ks in keys], shares)


def assess(docs: DataFrame, most_classes: float = 0.28, most_words: float = 0.45, least_common: float = 0.25,
           least_chars: int = 200, least_words: int = 50, least_expected: float = 12, **how) -> DataFrame:
    """Base measures of each document, its divergences, and whether it is kept.

    A document is held against the reference of the nearest language, that with the smallest sum of
    ``class_divergence`` and ``word_divergence``, the Jensen-Shannon distances of both histograms.
    ``common_share`` is the share of that language's common words in the text, over their share in
    the language: the distance alone cannot tell a text without any of them, since common words are
    a part of a language only. A document is kept if it passes the base rules, neither distance is above its
    limit and ``common_share`` is at least ``least_common``. A text with fewer than
    ``least_chars`` characters, or ``least_words`` words, is too short for the respective histogram
    to mean much, and one of which fewer than ``least_expected`` common words are to be expected for their
    share: these are null and not judged.
    A null or empty text has no words and so fails the base rules. Without any reference (no
    document has a language) nothing is judged beyond them. Repeated and null ids are rows like
    others; other columns are not read.
    """
    known = references(docs, **how)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in texts(batch):
                m = Measures.of(text)
                by_class = by_word = share = None
                classes, words = np.zeros(len(known.langs)), np.zeros(len(known.langs))
                usual = common = 0.0
                if known.langs and len(text) >= least_chars:
                    classes = divergence(m.classes / max(m.classes.sum(), 1), known.classes)
                if known.langs and m.n_words >= least_words:
                    tally = Counter(m.lower)
                    shares = []
                    for k, (at, q) in enumerate(zip(known.words, known.shares, strict=True)):
                        p = np.zeros(len(q))
                        for w, i in at.items():
                            p[i] = tally.get(w, 0)
                        shares.append(p.sum())
                        p[-1] = m.n_words - p.sum()
                        words[k] = divergence(p / m.n_words, q)
                if known.langs:
                    nearest = int(np.argmin(classes + words))
                    if len(text) >= least_chars:
                        by_class = float(classes[nearest])
                    if m.n_words >= least_words:
                        by_word, common = float(words[nearest]), shares[nearest] / m.n_words
                        usual = 1 - known.shares[nearest][-1]
                    if usual * m.n_words >= least_expected:
                        share = float(common / usual)
                kept = (not m.base_failed and (by_class or 0) <= most_classes and (by_word or 0) <= most_words
                        and (share is None or share >= least_common))
                rows.append((m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, m.base_failed,
                             kept, by_class, by_word, share))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 10
            types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 3
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       "kept", "class_divergence", "word_divergence", "common_share"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "base_failed boolean, kept boolean, class_divergence double, word_divergence double, common_share double")
