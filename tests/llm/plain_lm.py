"""The automaton in one place, for small tables: every kept n-gram collected, texts walked token by token."""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillwork.llm.common import settle, texts
from tillwork.llm.lm import ADDED, DISCOUNT, END, tokens_of

START_ID, END_ID = 0, 1


def word_counts(docs: DataFrame, most: int = 300_000) -> DataFrame:
    """(word, c): all tokens of all texts. Tasks add up before they send, ``most`` words at a time."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())],
                                               names=["word", "c"])
            seen.clear()
            return batch

        for batch in batches:
            for text in texts(batch):
                seen.update(tokens_of(text))
                if len(seen) > most:
                    yield out()
        yield out()

    return docs.select("text").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Model:
    """The kept n-grams: per order the sorted keys and counts.

    A key is (index of its first n-1 words among the kept n-grams of that order) * words + last
    word. Word 0 stands before every text, word 1 is its end.
    """
    words: list[bytes]  # from number 2 on
    counts: np.ndarray  # of words
    grams: list[tuple[np.ndarray, np.ndarray]]

    def find(self, order: int, prefix: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Index among the kept n-grams of ``order`` (2 or more), -1 where there is none."""
        keys = self.grams[order - 2][0]
        key = prefix * len(self.counts) + last
        if not len(keys):
            return np.full(len(key), -1)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where((prefix >= 0) & (last >= 0) & (keys[at] == key), at, -1)


def _sequence(batch: pa.RecordBatch, number: dict[bytes, int]) -> np.ndarray:
    """All texts' word numbers, each text after a start; -1 for words that no n-gram has."""
    ids: list[int] = []
    get = number.get
    for text in texts(batch):
        ids.append(START_ID)
        ids.extend([get(w, -1) for w in tokens_of(text)])
    return np.array(ids, np.int64)


def learn(docs: DataFrame, order: int = 3, share: float = 2e-5) -> tuple[DataFrame, int, int, Model]:
    """Counts of all words (stored), tokens, distinct tokens, and the n-grams of a model in one place.

    For small corpora, and to hold ``score`` against, which keeps no n-gram back. An n-gram is kept if it makes up at least ``share`` of all tokens (and occurs twice), at any
    size of the corpus, so there are 1 / share of an order at most, and what tasks are sent is
    bounded. Nothing is missed by building order on order: an n-gram is no more frequent than
    its parts. Counting covers all training documents.
    """
    counts = settle(word_counts(docs), "lm-words")
    total, distinct = counts.agg(F.sum("c"), F.count("*")).first()
    total = total or 0
    least = max(2, share * total)
    texts_, frequent = docs.count(), counts.where((F.col("c") >= least) & (F.col("word") != F.lit(END))).collect()
    frequent = sorted((bytes(w), c) for w, c in frequent)
    model = Model([w for w, _ in frequent], np.array([texts_, texts_, *(c for _, c in frequent)], np.int64), [])
    number = {END: END_ID} | {w: i + 2 for i, w in enumerate(model.words)}
    for n in range(2, order + 1):
        shared = docs.sparkSession.sparkContext.broadcast((number, model))

        def count(batches: Iterator[pa.RecordBatch], n: int = n, shared=shared) -> Iterator[pa.RecordBatch]:
            number, model = shared.value
            for batch in batches:
                ids = _sequence(batch, number)
                gram = ids  # index of the kept k-gram that ends at each place
                for k in range(2, n):
                    gram = np.concatenate([[-1], model.find(k, gram[:-1], ids[1:])])
                # both parts of a kept n-gram are kept: what precedes its last word, what follows its first
                prefix, last = gram[:-1], np.where(gram[1:] >= 0, ids[1:], -1)
                some = (prefix >= 0) & (last >= 0) & (last != START_ID)
                keys, c = np.unique(prefix[some] * len(model.counts) + last[some], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(c.astype(np.int64))], names=["key", "c"])

        kept = (docs.select("text").mapInArrow(count, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))
                .where(F.col("c") >= least).orderBy("key").collect())
        model.grams.append((np.array([r["key"] for r in kept], np.int64), np.array([r["c"] for r in kept], np.int64)))
    return counts, int(total), int(distinct), model


class Automaton:
    """States are contexts, the root the empty one. An arc reads a word: log10 probability, next state.

    Where a state has no arc for a word, its failure arc goes to the context without its first
    word, at the cost of the state's backoff weight. The root reads any word by its own probability.
    """

    def __init__(self, model: Model, total: int, distinct: int):
        size = len(model.counts)
        self.size, self.start = size, START_ID + 1
        root = (model.counts + ADDED) / (total + ADDED * (distinct + 1))
        # states: 0 the root, then each order's n-grams in turn, as far as they are contexts
        self.fail, self.weight = [0, *([0] * size)], [0.0]
        self.arcs: dict[int, tuple[float, int]] = {}
        contexts, shorter, lower, first = model.counts, None, root, 1
        for n, (keys, counts) in enumerate(model.grams, start=2):
            prefix, last = np.divmod(keys, size)
            suffix = last if n == 2 else model.find(n - 1, shorter[prefix], last)
            p = (counts - DISCOUNT) / np.maximum(contexts[prefix], 1)
            left = 1 - np.bincount(prefix, p, len(contexts))
            rest = 1 - np.bincount(prefix, lower[suffix], len(contexts))
            self.weight += np.log10(np.maximum(left, 1e-12) / np.maximum(rest, 1e-12)).tolist()
            # after an n-gram: itself where longer ones have it as context, else what follows its first word
            longest = n == len(model.grams) + 1
            after = first + suffix if longest else first + len(contexts) + np.arange(len(keys))
            self.arcs.update(zip(((first + prefix) * size + last).tolist(), zip(np.log10(p).tolist(), after.tolist())))
            if not longest:
                self.fail += (first + suffix).tolist()
                first += len(contexts)
            contexts, shorter, lower = counts, suffix, p
        if not model.grams:
            self.weight += [0.0] * size
        down: list[float] = []
        for s, f in enumerate(self.fail):
            down.append(self.weight[s] + (down[f] if s else 0.0))
        self.to_root = down

    def score(self, words: list[int], logs: list[float]) -> float:
        """Log10 probability of a text, left to right; ``logs`` are the words' own at the root."""
        get, size, fail, weight, to_root = self.arcs.get, self.size, self.fail, self.weight, self.to_root
        state, sum_ = self.start, 0.0
        for w, log in zip(words, logs, strict=True):
            if w < 0:  # no arc anywhere: all failure arcs down to the root
                sum_ += to_root[state] + log
                state = 0
                continue
            while True:
                arc = get(state * size + w)
                if arc is not None:
                    sum_ += arc[0]
                    state = arc[1]
                    break
                if not state:
                    sum_ += log
                    state = w + 1
                    break
                sum_ += weight[state]
                state = fail[state]
        return sum_
