"""Language ID by unigram pieces, summed over all segmentations of each word."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tillwork.llm.common import blocks, held, packed, texts, unpacked

#: A piece that begins a word carries this mark in the public vocabulary.
START = "▁"
#: Words are runs of letters, in lower case; a run of over 40 letters is scored 40 at a time.
words_of = re.compile(r"[^\W\d_]{1,40}").findall
#: A letter that no piece covers, in every language alike.
UNSEEN = 1e-7
#: Words a worker remembers the scores of before it starts anew, with up to ``AT_ONCE`` languages; fewer with more.
REMEMBERED = 400_000
#: Characters of one block of texts, about; likewise.
BLOCK_CHARS = 3_000_000
#: Languages scored at once.
AT_ONCE = 16


def vocabulary(path: str, longest: int = 6) -> list[str]:
    """The vocabulary's pieces of at most ``longest`` letters, in lower case as they stand."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return sorted({p for p in pieces if p.removeprefix(START).isalpha() and p == p.lower()
                   and len(p.removeprefix(START)) <= longest} | {START})


class Lattice:
    """All segmentations of many words into pieces, as one array of piece numbers a word length."""

    def __init__(self, pieces: list[str]):
        self.number = {p: i for i, p in enumerate(pieces)}
        self.none, self.unseen = len(pieces), len(pieces) + 1
        self.longest = max(map(len, pieces), default=1)

    def by_length(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]]:
        """Positions of the words in the list, their pieces' numbers (word x span), and the spans."""
        groups: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            groups.setdefault(len(w) + 1, []).append(k)
        get, none, unseen = self.number.get, self.none, self.unseen
        for n, members in groups.items():
            spans = [(i, j) for j in range(1, n + 1) for i in range(max(0, j - self.longest), j)]
            cuts = [slice(i, j) for i, j in spans]
            missing = [unseen if j - i == 1 else none for i, j in spans]
            for at in range(0, len(members), 20_000):
                part = members[at:at + 20_000]
                flat = [get(w[c], m) for k in part for w in (START + words[k],) for c, m in zip(cuts, missing)]
                yield np.array(part), np.array(flat, np.int32).reshape(len(part), -1), spans


def forward(ids: np.ndarray, spans: list[tuple[int, int]], prob: np.ndarray) -> np.ndarray:
    """Probability of each word's prefixes (word x position x language), over all segmentations.

    Piece probabilities are scaled by 100 a letter, which keeps the sums in range and is taken
    back by nobody: it is the same for all languages.
    """
    n = spans[-1][1]
    alpha = np.zeros((len(ids), n + 1, prob.shape[1]))
    alpha[:, 0] = 1
    for s, (i, j) in enumerate(spans):
        alpha[:, j] += alpha[:, i] * prob[ids[:, s]] * 100.0 ** (j - i)
    return alpha


def fit(words: list[str], counts: np.ndarray, pieces: list[str], rounds: int = 3) -> np.ndarray:
    """Piece probabilities of one language by expectation maximisation on its word counts."""
    lattice = Lattice(pieces)
    layers = [(counts[at], ids, spans) for at, ids, spans in lattice.by_length(words)]
    size = len(pieces) + 2
    # to begin with, a piece is as likely as it occurs, less so the shorter it is
    expected = np.zeros(size)
    for weight, ids, spans in layers:
        for s, (i, j) in enumerate(spans):
            expected += np.bincount(ids[:, s], weight * (j - i), size)
    for _ in range(rounds + 1):
        expected[lattice.none] = expected[lattice.unseen] = 0
        prob = (expected + 0.01) / (expected.sum() + 0.01 * len(pieces))
        prob[lattice.none], prob[lattice.unseen] = 0, UNSEEN
        column = prob[:, None]
        expected = np.zeros(size)
        for weight, ids, spans in layers:
            alpha = forward(ids, spans, column)[:, :, 0]
            n = spans[-1][1]
            beta = np.zeros_like(alpha)
            beta[:, n] = 1
            for s in range(len(spans) - 1, -1, -1):
                i, j = spans[s]
                beta[:, i] += beta[:, j] * prob[ids[:, s]] * 100.0 ** (j - i)
            scale = weight / alpha[:, n]
            for s, (i, j) in enumerate(spans):
                share = alpha[:, i] * prob[ids[:, s]] * 100.0 ** (j - i) * beta[:, j] * scale
                expected += np.bincount(ids[:, s], share, size)
    return prob[:len(pieces)]


def held_out(doc_id: Column) -> Column:
    """Never learned from: crc32 of the id as text leaves 2 when divided by 4 (null: of no bytes)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def learn(docs: DataFrame, path: str | None = None, sample: int = 1000,
          longest: int = 6) -> tuple[list[str], list[str], np.ndarray]:
    """Languages, pieces and their probabilities (piece x language) from labelled documents.

    The classifier is fitted on about ``sample`` documents of each language, drawn by a hash of
    the id, a parameter of the model, and knows every language that has any. Words are counted by Spark, each language is fitted in its own task, and the model
    that reaches the driver has a row per piece of the fixed vocabulary and language at most.
    """
    pieces = vocabulary(path or public_tokenizers.path("piece_bpe_32k.model"), longest)
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select(
        "doc_id", "lang", "text")
    found = known.groupBy("lang").count().collect()
    langs = sorted(r["lang"] for r in found)
    if not langs:
        return [], pieces, np.zeros((len(pieces) + 2, 0))
    rate = F.create_map(*[F.lit(x) for r in found for x in (r["lang"], min(1.0, sample / r["count"]))])
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    drawn = known.where(F.col("lang").isin(langs) & (draw < rate[F.col("lang")]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch), strict=True):
                seen.setdefault(lang, Counter()).update(words_of(text.lower()))
            rows = [(lang, w, n) for lang, c in seen.items() for w, n in c.items()]
            lang, word, n = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(word, pa.string()),
                                              pa.array(n, pa.int64())], names=["lang", "word", "n"])

    def fit_one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        prob = fit(rows["word"].tolist(), rows["n"].to_numpy(float), pieces)
        some = prob > 0
        some[:1] = True  # a language without any known piece stays one
        return pd.DataFrame({"lang": key[0], "piece": np.flatnonzero(some), "p": prob[some]})

    counts = (drawn.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
              .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    model = counts.groupBy("lang").applyInPandas(fit_one, "lang string, piece long, p double").toPandas()
    langs = sorted(set(model["lang"]))
    prob = np.zeros((len(pieces) + 2, len(langs)))
    prob[-1] = UNSEEN
    prob[model["piece"], model["lang"].map(langs.index)] = model["p"]
    return langs, pieces, prob


class Scorer:
    """Scores words, each distinct one once while it is remembered."""

    def __init__(self, pieces: list[str], prob: np.ndarray):
        self.lattice, self.prob = Lattice(pieces), prob
        self.share = AT_ONCE / max(AT_ONCE, prob.shape[1])
        self.clear()

    def clear(self) -> None:
        self.row: dict[str, int] = {}
        self.logs = np.empty((int((1 << 16) * self.share), self.prob.shape[1]), np.float32)

    def learn(self, new: list[str]) -> None:
        base = len(self.row)
        while base + len(new) > len(self.logs):
            self.logs = np.concatenate([self.logs, np.empty((len(self.logs) + 1, self.logs.shape[1]), np.float32)])
        for at, ids, spans in self.lattice.by_length(new):
            for k in range(0, self.prob.shape[1], AT_ONCE):
                with np.errstate(divide="ignore"):
                    self.logs[base + at, k:k + AT_ONCE] = np.log(forward(ids, spans, self.prob[:, k:k + AT_ONCE])[:, -1])
        self.row.update(zip(new, range(base, base + len(new))))

    def score(self, found: list[str]) -> np.ndarray:
        """Log probability of each text by language; texts without a letter get nan."""
        out = np.full((len(found), self.prob.shape[1]), np.nan)
        for start, end in blocks(found, int(BLOCK_CHARS * self.share)):
            if len(self.row) > REMEMBERED * self.share:
                self.clear()
            words = [words_of(t.lower()) for t in found[start:end]]
            new: set[str] = set()
            for ws in words:
                new.update(ws)
            self.learn(list(new.difference(self.row)))
            row = self.row.__getitem__
            for k, ws in enumerate(words, start):
                if ws:
                    out[k] = self.logs[np.fromiter(map(row, ws), np.int64, len(ws))].sum(axis=0, dtype=float)
        return out


def predict(rows: DataFrame, model: tuple[list[str], list[str], np.ndarray]) -> DataFrame:
    """``packed`` rows with ``lang_pred`` and ``score``: the likeliest language and its share.

    Only the text is looked at, all of it. The share compares the languages' probabilities of
    the text. ``und`` with score 0 where the text is null or has no letter, or nothing was
    learned; ties go to the first language by name.
    """
    langs, pieces, prob = model
    shared = rows.sparkSession.sparkContext.broadcast((pieces, prob))
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = held(name, lambda: Scorer(*shared.value))
        for batch in batches:
            row = batch.column("row")
            lang, score = ["und"] * batch.num_rows, np.zeros(batch.num_rows)
            if langs:
                logs = scorer.score([t or "" for t in row.field("text").to_pylist()])
                some = ~np.isnan(logs[:, 0])
                best = np.argmax(np.where(np.isnan(logs), -np.inf, logs), axis=1)
                for k in np.flatnonzero(some):
                    lang[k] = langs[best[k]]
                    score[k] = 1 / np.exp(np.maximum(logs[k] - logs[k, best[k]], -700)).sum()
            yield pa.RecordBatch.from_arrays([row, pa.array(lang, pa.string()), pa.array(score)],
                                             names=["row", "lang_pred", "score"])

    return rows.mapInArrow(run, T.StructType([rows.schema["row"]]).add("lang_pred", "string").add("score", "double"))


def identify(docs: DataFrame, **how) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document; learned from those not held out.

    A null or letterless text is ``und`` with score 0, as is every text if no document has a
    language to learn. Repeated and null ids are rows like others; a null id is not held out.
    Other columns are not read.
    """
    found = predict(packed(docs.select("doc_id", "text")), learn(docs, **how))
    return found.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float = 0.5, **how) -> DataFrame:
    """The documents whose language is told with a share of at least ``least``; same columns."""
    found = predict(packed(docs), learn(docs, **how))
    return unpacked(found.where((F.col("lang_pred") != "und") & (F.col("score") >= least)))
