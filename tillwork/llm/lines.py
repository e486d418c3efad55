"""Line dedup by a log-template tree: token count, leading tokens, then constant and variable fields."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tillwork.llm.common import packed, settle, texts, unpacked
from tillwork.operators.skew import own_exchange

#: A field that differs from line to line.
ANY = b"<*>"
_variable = re.compile(rb"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*").sub
_digit = re.compile(rb"[0-9]").search
_letter = re.compile(rb"[A-Za-z\x80-\xff]").search


def tokens_of(line: bytes) -> list[bytes]:
    """The words of a line; one with a digit is a variable field."""
    return (_variable(ANY, line) if _digit(line) else line).split()


def _hash(data: bytes) -> int:
    x = xxhash.xxh64_intdigest(data, 42)
    return x - (1 << 64) if x >= 1 << 63 else x


def _id(docs: DataFrame, name: str = "doc_id") -> Column:
    """What orders documents: the id where it is a whole number, else a hash of it; a missing one comes last."""
    whole = dict(docs.dtypes)["doc_id"] in ("tinyint", "smallint", "int", "bigint")
    of = F.col(name).cast("long") if whole else F.xxhash64(F.col(name).cast("string"))
    return F.when(F.col(name).isNull(), F.lit((1 << 63) - 1)).otherwise(of)


def _leaves(docs: DataFrame, depth: int, short: int) -> DataFrame:
    """A row per line with a letter: its text, its place there, its leaf of the tree, a key of its
    tokens, and one of its words as they stand."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch), strict=True):
                raw = text.encode()
                key = _hash(raw)
                for at, line in enumerate(raw.split(b"\n")):
                    if _letter(line):
                        tokens = tokens_of(line)
                        n = len(tokens)
                        of_line = _hash(b" ".join(tokens))
                        leaf = of_line if n < short else _hash(b"%d " % n + b" ".join(tokens[:depth]))
                        same = _hash(b" ".join(line.split()))
                        rows.append((key, doc_id, at, leaf, of_line, n, same))
            columns = list(zip(*rows, strict=True)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=["text", "doc_id", "at", "leaf", "line", "n", "same"])

    return docs.select(_id(docs).alias("doc_id"), "text").mapInArrow(
        run, "text long, doc_id long, at long, leaf long, line long, n long, same long")


def _tokens(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(leaf, line, weight, n, pos, token) of the lines named in ``wanted`` by text and place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, lines in zip(texts(batch), batch.column("lines").to_pylist(), strict=True):
                parts = text.encode().split(b"\n")
                for x in lines:
                    rows += [(x["leaf"], x["line"], x["weight"], x["n"], pos, _hash(token))
                             for pos, token in enumerate(tokens_of(parts[x["at"]])) if token != ANY]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=["leaf", "line", "weight", "n", "pos", "token"])

    by_doc = wanted.groupBy("doc_id", "text").agg(
        F.collect_list(F.struct("leaf", "line", "weight", "n", "at")).alias("lines"))
    found = docs.select(_id(docs).alias("doc_id"), F.xxhash64("text").alias("_key"), "text").join(
        by_doc.withColumnRenamed("text", "_of"), "doc_id").where("_key = _of")
    rows = found.select("text", "lines").mapInArrow(
        run, "leaf long, line long, weight long, n long, pos long, token long")
    return rows.dropDuplicates(["leaf", "line", "pos"])  # repeated rows of the table


def recurring(docs: DataFrame, depth: int = 3, short: int = 5, least_texts: int = 10,
              least_constant: float = 0.6) -> DataFrame:
    """(text, doc_id, drop): by hash of a text and its document, the places of lines that repeat a recurring template.

    The tree has a fixed depth: the number of tokens, then the leading ones; a line of fewer than
    ``short`` tokens, such as one without spaces, has a leaf of its own. Below that, a token
    is a constant of its leaf if it stands at its place in lines of ``least_texts`` different
    texts or more; all others are variable fields. Constants and their places make the line's
    template. One with variable fields recurs if it has at least the share ``least_constant`` of
    constants and occurs in ``least_texts`` different texts. One whose fields are all constant, a line
    that stands word by word in two different texts, recurs from these two on.
    A template's first line stays, in the text with the smallest doc_id; the others go, and lines without a letter stay.

    Copies of a text count as one text and stay copies, whoever they are. Leaves are never
    gathered: constants are counted by (leaf, place, token), templates by sums of hashes.
    """
    lines = settle(_leaves(docs, depth, short), "lines")
    pairs = lines.groupBy("leaf", "line", "text").agg(F.min(F.struct("doc_id", "at", "n")).alias("first"))
    pairs = settle(pairs.select("leaf", "line", "text", "first.*"), "line-texts")
    distinct = pairs.groupBy("leaf", "line").agg(F.count("*").alias("weight"),
                                                 F.min(F.struct("doc_id", "at", "text", "n")).alias("first"))
    full = pairs.groupBy("leaf").agg(F.count("*").alias("_all")).where(F.col("_all") >= least_texts).select("leaf")
    wanted = distinct.join(own_exchange(full, "leaf"), "leaf").select("leaf", "line", "weight", "first.*")
    tokens = settle(_tokens(docs, wanted), "line-tokens")

    constants = tokens.groupBy("leaf", "pos", "token").agg(F.sum("weight").alias("_n"))
    constants = constants.where(F.col("_n") >= least_texts).select("leaf", "pos", "token", F.lit(1).alias("_constant"))
    marked = tokens.join(own_exchange(constants, "leaf", "pos", "token"), ["leaf", "pos", "token"], "left")
    signs = F.bit_xor(F.when(F.col("_constant") == 1, F.xxhash64("pos", "token")))
    templates = (marked.groupBy("leaf", "line")
                 .agg(F.xxhash64("leaf", F.coalesce(signs, F.lit(0))).alias("template"),
                      F.count("_constant").alias("_constants"), F.max("n").alias("n"))
                 .where(F.col("_constants") >= least_constant * F.col("n")).select("line", "template"))
    templates = settle(templates, "line-templates")

    seen = pairs.join(templates, "line").groupBy("template", "text").agg(F.min(F.struct("doc_id", "at")).alias("at"))
    often = (seen.groupBy("template").agg(F.count("*").alias("_texts"), F.min(F.struct("at", "text")).alias("_first"))
             .where(F.col("_texts") >= least_texts)
             .select("template", F.col("_first.text").alias("_text"), F.col("_first.at.at").alias("_at")))
    known = templates.join(often, "template").select("line", "_text", "_at")
    same = (lines.groupBy("same")
            .agg(F.min("text").alias("_a"), F.max("text").alias("_b"), F.min(F.struct("doc_id", "at", "text")).alias("_first"))
            .where("_a <> _b").select("same", F.col("_first.text").alias("_text"), F.col("_first.at").alias("_at")))
    places = [lines.select(key, "text", "doc_id", "at").join(own_exchange(first, key), key)
              .where("text <> _text OR at <> _at").select("text", "doc_id", "at")
              for key, first in (("line", known), ("same", same))]
    return places[0].union(places[1]).groupBy("text", "doc_id").agg(F.collect_set("at").alias("drop"))


def dedup(docs: DataFrame, **how) -> DataFrame:
    """``packed`` documents with recurring lines dropped, and n_lines and n_dropped of each.

    What is left keeps its order and line breaks. A null text stays null with 0 lines; an empty
    one has one empty line. Lines without a letter stay. Texts that lose nothing
    stay as they are; one may lose all its lines and stay as an empty text. A null doc_id comes last
    where the first occurrence is chosen, ids that are no whole numbers come by their hash;
    repeated rows are copies of one text.
    """
    # by document as well, so that copies of a text do not meet in one task
    drops = recurring(docs, **how).select(F.col("text").alias("_of"), F.col("doc_id").alias("_doc"), "drop")
    rows = packed(docs).withColumns({"_key": F.xxhash64("row.text"), "_doc_key": _id(docs, "row.doc_id")})
    rows = rows.join(drops, (F.col("_key") == F.col("_of")) & (F.col("_doc_key") == F.col("_doc")), "left")
    parts = F.split("row.text", "\n", -1)
    left = F.array_join(F.filter(parts, lambda _, i: ~F.array_contains(F.col("drop"), i.cast("long"))), "\n")
    row = F.when(F.col("drop").isNull(), F.col("row")).otherwise(F.col("row").withField("text", left))
    return rows.select(row.alias("row"), F.when(F.col("row.text").isNull(), 0).otherwise(F.size(parts)).cast("long").alias("n_lines"),
                       F.when(F.col("drop").isNull(), 0).otherwise(F.size("drop")).cast("long").alias("n_dropped"))


def keep_first(docs: DataFrame, **how) -> DataFrame:
    """The documents with recurring lines dropped; columns are those of ``docs``.

    Where a text lost lines, a column ``n_chars`` gets its new length.
    """
    found = dedup(docs, **how)
    if "n_chars" in docs.columns:
        length = F.char_length("row.text").cast(dict(docs.dtypes)["n_chars"])
        found = found.withColumn("row", F.when(F.col("n_dropped") > 0, F.col("row").withField("n_chars", length))
                                 .otherwise(F.col("row")))
    return unpacked(found)


def digest(found: DataFrame) -> DataFrame:
    return found.select("row.doc_id", "n_lines", "n_dropped",
                        F.sha2(F.coalesce("row.text", F.lit("")), 256).alias("kept_sha256"))
