"""LM scoring: a smoothed n-gram model as a weighted automaton with failure arcs."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tillwork.llm.common import LOWER, settle, settle_and_free, texts

#: The token after the last word. Words hold no white space, so it is none of them.
END = b"\n"
#: The discount of every n-gram's count, and what is added to every word's.
DISCOUNT, ADDED = 0.75, 0.1


def tokens_of(text: str) -> list[bytes]:
    tokens = text.encode().translate(LOWER).split()
    tokens.append(END)
    return tokens


def held_out(doc_id: Column) -> Column:
    """Never learned from: crc32 of the id as text divides by 10 (a null id: of no bytes, so held out)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 10 == 0


# Scoring at any size. Texts lie in stored blocks. Each block asks for its distinct n-grams, with its own
# training counts, at parts of the key space, and parts answer with the corpus counts: one exchange
# counts and looks up. Contexts' backoff weights are summed up and looked up in the same way.

_ODD, _FURTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_START_KEY = np.uint64(0x5851F42D4C957F2D)


def _pack(values: np.ndarray) -> bytes:
    """Eight-byte values, byte by byte of all, compressed."""
    return pa.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int, kind: type) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, n).T).view(kind).ravel()


def _apart(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))  # of sorted keys: smaller numbers


def stored_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Rows of (block, ids, held, sizes, data): texts of about ``block_bytes`` each, as they come, compressed."""
    kind = dict(docs.dtypes)["doc_id"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n = TaskContext.get().partitionId() << 32, 0
        ids: list = []
        held: list[bool] = []
        found: list[bytes] = []
        size = 0

        def out() -> pa.RecordBatch:
            sizes = pa.array([[len(t) for t in found]], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays(
                [pa.array([first + n], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([held], pa.list_(pa.bool_())),
                 sizes, pa.array([pa.compress(b"".join(found), codec="zstd", asbytes=True)], pa.binary())],
                names=["block", "ids", "held", "sizes", "data"])

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("held").to_pylist(), texts(batch), strict=True)
            for i, h, text in rows:
                ids.append(i)
                held.append(h)
                found.append(text.encode())
                size += len(found[-1])
                if size >= block_bytes:
                    yield out()
                    ids, held, found, size, n = [], [], [], 0, n + 1
        if found:
            yield out()

    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held"))
    return rows.mapInArrow(work, f"block long, ids array<{kind}>, held array<boolean>, sizes array<long>, data binary")


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct keys, and each key's index among them."""
    low = np.uint64((1 << len(keys).bit_length()) - 1)
    # numbers sort faster than they are argsorted: the places take the low bits, which rarely decide
    order = (np.sort((keys & ~low) | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)
    keys_ = keys[order]
    if (keys_[1:] < keys_[:-1]).any():
        order = np.argsort(keys)
        keys_ = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys_[1:] != keys_[:-1]
    back = np.empty(len(keys), np.int32)
    back[order] = np.cumsum(new, dtype=np.int32) - 1
    return keys_[new], back


class Block:
    """A block's n-grams. ``keys[n - 1]`` are the sorted distinct 64-bit keys of order n. To ask for them,
    ``counts`` are their own training counts; to read, ``at[n - 1]`` has each place's index among them, -1
    where fewer than n tokens end, and ``where`` one place of each."""

    def __init__(self, sizes: list[int], held: list[bool], data: bytes, order: int, to_ask: bool = False):
        joined = pa.decompress(data, decompressed_size=sum(sizes), codec="zstd", asbytes=True)
        tokens: list[bytes] = []
        start, ends = 0, []
        for size in sizes:
            tokens += joined[start:start + size].translate(LOWER).split()
            start += size
            tokens.append(END)
            ends.append(len(tokens))
        coded = pa.array(tokens, pa.large_binary()).dictionary_encode()
        del tokens, joined
        self.lengths = np.diff(ends, prepend=0)
        self.firsts = np.cumsum(self.lengths + 1) - self.lengths - 1  # the places before texts
        self.place = (np.arange(len(coded) + len(sizes)) - np.repeat(self.firsts, self.lengths + 1)).astype(np.int32)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, coded.dictionary.to_numpy(zero_copy_only=False)), np.uint64)
        words = np.full(len(self.place), _START_KEY)
        words[self.place > 0] = hashes[coded.indices.to_numpy()]
        del coded, hashes
        learned = np.repeat(~np.array(held, bool), self.lengths + 1) if to_ask else None
        self.keys, self.at, self.where, self.counts = [], [], [], []
        key = words
        for n in range(1, order + 1):
            if n > 1:
                key = np.concatenate([key[:1], key[:-1]]) * _ODD + words
                key = (key ^ (key >> np.uint64(31))) * _FURTHER
                key ^= key >> np.uint64(29)
            some = np.flatnonzero(self.place >= n - 1).astype(np.int32)
            distinct, back = _numbered(key[some])
            if to_ask:
                self.counts.append(np.bincount(back[learned[some]], minlength=len(distinct)))
            else:
                one = np.empty(len(distinct), np.int32)
                one[back] = some
                at = np.full(len(words), -1, np.int32)
                at[some] = back
                self.at.append(at)
                self.where.append(one)
            self.keys.append(distinct)

    def parts(self, n: int, parts: int, some: np.ndarray | slice = slice(None)) -> Iterator[tuple[int, int, int]]:
        """(part, start, end) of the sorted keys of order n: stretches of the key space."""
        part = ((self.keys[n - 1][some] >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        if len(part):
            cuts = np.flatnonzero(np.diff(part)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(part)]):
                yield int(part[a]), int(a), int(b)

    def answers(self, rows: list[dict], k: int = 1) -> list[np.ndarray]:
        """The ``k`` numbers that parts answered, by order: k rows in the order of the keys asked for."""
        out = []
        for n in range(1, len(self.keys) + 1):
            found = sorted((r["part"], r["size"], r["data"]) for r in rows if r["n"] == n)
            out.append(np.concatenate([np.zeros((k, 0), np.int64), *(
                _unpack(data, k * size, np.int64).reshape(k, size) for _, size, data in found)], axis=1))
        return out


class Known:
    """A block's n-grams with their corpus counts (0: no arc) and arcs' probabilities."""

    def __init__(self, block: Block, rows: list[dict], least: int, total: int, distinct: int):
        told = [t[0] for t in block.answers(rows)]
        self.block, self.counts, self.mine = block, [t >> 1 for t in told], [(t & 1).astype(bool) for t in told]
        self.norm = total + ADDED * (distinct + 1)
        self.p = [(self.counts[0] + ADDED) / self.norm]
        self.prefix, self.suffix = [], []
        for n in range(2, len(told) + 1):
            where, shorter = block.where[n - 1], block.at[n - 2]
            self.prefix.append(shorter[where - 1])
            self.suffix.append(shorter[where])
            c = self.counts[n - 1]
            self.p.append(np.where(c > 0, (c - DISCOUNT) / np.maximum(self.counts[n - 2][self.prefix[-1]], 1), 0.0))
        # by order, contexts that some place of the block falls back from, and those that it sees to
        self.falls, self.contexts = [], []
        for n, c in enumerate(self.counts[:-1], start=1):
            places = np.flatnonzero(block.place >= n)
            places = places[self.counts[n][block.at[n][places]] == 0]
            falls = np.zeros(len(c), bool)
            falls[block.at[n - 1][places - 1]] = True
            asks = falls.copy()
            asks[self.prefix[n - 1][self.mine[n]]] = True
            self.falls.append(falls)
            self.contexts.append(np.flatnonzero(asks & (c >= least)))

    def weights(self, n: int, sums: np.ndarray) -> np.ndarray:
        """Backoff weights (log10) of all n-grams, from sums over what follows ``contexts``: how many
        tokens do, their counts after the context, and their counts after the context without its
        first word, which is the same for all of them."""
        some = self.contexts[n - 1]
        many, here, shorter = sums.astype(np.float64)
        left = 1 - (here - DISCOUNT * many) / np.maximum(self.counts[n - 1][some], 1)
        if n == 1:
            rest = 1 - (shorter + ADDED * many) / self.norm
        else:
            context = self.counts[n - 2][self.suffix[n - 2][some]]
            rest = 1 - (shorter - DISCOUNT * many) / np.maximum(context, 1)
        out = np.zeros(len(self.counts[n - 1]))
        out[some] = np.log10(np.maximum(left, 1e-12) / np.maximum(rest, 1e-12))
        return out


class Arcs:
    """A block's automaton. States are contexts, 0 the root and 1 + g the n-gram number g; an n-gram is the
    arc that leaves the state of all its words but the last and reads that one. Where a state has no arc for
    a word, its failure arc goes to the context without its first word, at the cost of the backoff
    weight. The root reads any word by its own probability.
    """

    def __init__(self, block: Block, known: Known, sums: list[np.ndarray]):
        sizes = [len(keys) for keys in block.keys]
        self.first = [0, *np.cumsum(sizes).tolist()]  # each order's first n-gram
        self.reach = len(sizes) - 1  # words that a state stands for at most
        state = lambda n, of: (1 + self.first[n - 1] + of).astype(np.int32)
        logs, leaves, after, fail, weight = [], [], [], [np.zeros(1, np.int32)], [np.zeros(1)]
        for n, size in enumerate(sizes, start=1):
            kept = known.counts[n - 1] > 0
            suffix = state(n - 1, known.suffix[n - 2]) if n > 1 else np.zeros(size, np.int32)
            logs.append(np.log10(np.where(kept, known.p[n - 1], 1.0) if n > 1 else known.p[0]))
            leaves.append(np.where(kept, state(n - 1, known.prefix[n - 2]), -1) if n > 1 else np.zeros(size, np.int32))
            if n <= self.reach:
                after.append(state(n, np.arange(size)))
                fail.append(suffix)
                weight.append(known.weights(n, sums[n - 1]))
            else:
                after.append(suffix)
        self.logs, self.leaves, self.after, self.fail, self.weight = map(np.concatenate, (logs, leaves, after, fail, weight))
        self.depth = np.repeat(np.arange(self.reach + 1, dtype=np.int8), [1, *sizes[:self.reach]])

    def read(self, block: Block, state: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each state reads the word at its place: log10 probability, next state."""
        log, arc = np.zeros(len(state)), np.empty(len(state), np.int64)
        at = np.arange(len(state))  # those that have not read yet
        for depth in range(self.reach, -1, -1):
            here = self.depth[state] == depth
            some, of = at[here], state[here]
            found = self.first[depth] + block.at[depth][place[some]]
            has = self.leaves[found] == of
            log[some[has]] += self.logs[found[has]]
            arc[some[has]] = found[has]
            falls = ~has
            log[some[falls]] += self.weight[of[falls]]
            at = np.concatenate([at[~here], some[falls]])
            state = np.concatenate([state[~here], self.fail[of[falls]]])
        return log, self.after[arc]

    def scores(self, block: Block, stretch: int) -> np.ndarray:
        """Log10 probability of each text, from left to right, all texts at once. A text of over ``stretch``
        words goes in several: a state knows ``reach`` words, so one that starts at the root as many words
        ahead has the text's own state where its stretch begins."""
        many = -(-block.lengths // stretch)
        text = np.repeat(np.arange(len(many)), many)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
        ahead = np.where(nth > 0, self.reach, 0)
        length = np.minimum(stretch, block.lengths[text] - nth * stretch) + ahead
        order = np.argsort(-length, kind="stable")
        text, nth, ahead, length = text[order], nth[order], ahead[order], length[order]
        place = block.firsts[text] + 1 + nth * stretch - ahead
        start = 1 + block.at[0][block.firsts[text]] if self.reach else 0
        state = np.where(nth > 0, 0, start).astype(np.int32)
        sums = np.zeros(len(text))
        for k in range(int(length[0])):
            n = int(np.searchsorted(-length, -k))  # those with a word left
            log, state[:n] = self.read(block, state[:n], place[:n] + k)
            sums[:n] += np.where(k < ahead[:n], 0.0, log)
        return np.bincount(text, sums, len(many))


def score(docs: DataFrame, order: int = 3, least: int = 2, block_bytes: int = 8_000_000,
          stretch: int = 256) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    Tokens are the words in lower case (A-Z) and one end. ``base_score`` adds the words' own log10
    probabilities, ``score`` is that of the automaton whose states are all n-grams seen ``least``
    times or more: each text is read from left to right, the k-th words of all texts of a block at
    once, and the states that were reached carried on, by arcs or failure arcs. Neither words nor
    n-grams, which grow with the corpus, are ever in one place: a block is told of those it meets.
    They go by 64-bit hashes,
    so of N distinct n-grams about N * N / 2 ** 65 pairs are taken for one. A null or empty text is
    one end. A null doc_id is held out; repeated rows are scored each, and learned from each, if
    not held out. Without training documents every probability is that of a corpus without tokens.
    """
    stored = settle(stored_blocks(docs, block_bytes), "lm-blocks")
    size = stored.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b))).first()[0] or 0
    parts = size // (2 * block_bytes) + 1

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                b, sizes, held, data = (batch.column(c)[row].as_py() for c in ("block", "sizes", "held", "data"))
                block = Block(sizes, held, data, order, to_ask=True)
                for n in range(1, order + 1):
                    cut = list(block.parts(n, parts))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p for p, _, _ in cut], pa.int64()), pa.array([b] * len(cut), pa.int64()),
                         pa.array([n] * len(cut), pa.int64()), pa.array([j - i for _, i, j in cut], pa.int64()),
                         pa.array([_pack(_apart(block.keys[n - 1][i:j])) for _, i, j in cut], pa.binary()),
                         pa.array([_pack(block.counts[n - 1][i:j]) for _, i, j in cut], pa.binary())],
                        names=["part", "block", "n", "size", "keys", "counts"])

    def in_part(asked: pa.Table) -> Iterator[tuple[int, list[dict], np.ndarray, np.ndarray, np.ndarray]]:
        """By order: the rows, by block; all keys asked for: distinct ones, a first place and index of each."""
        rows = sorted(asked.to_pylist(), key=lambda r: (r["n"], r["block"]))
        for n, of_n in itertools.groupby(rows, key=lambda r: r["n"]):
            of_n = list(of_n)
            keys = np.concatenate([np.cumsum(_unpack(r["keys"], r["size"], np.uint64), dtype=np.uint64) for r in of_n])
            distinct, back = np.unique(keys, return_inverse=True)
            first = np.empty(len(distinct), np.int64)
            first[back[::-1]] = np.arange(len(back))[::-1]
            yield n, of_n, distinct, first, back

    def told(rows: list[dict], values: np.ndarray) -> list[dict]:
        ends = np.cumsum([r["size"] for r in rows])
        return [{"block": r["block"], "n": r["n"], "part": r["part"], "size": r["size"], "data": _pack(np.ascontiguousarray(values[..., e - r["size"]:e]).ravel()),
                 "total": 0, "distinct": 0} for r, e in zip(rows, ends, strict=True)]

    as_told = "block long, n long, part long, size long, data binary, total long, distinct long"
    told_type = pa.schema([(c, pa.binary() if c == "data" else pa.int64())
                           for c in ("block", "n", "part", "size", "data", "total", "distinct")])

    def add_up(asked: pa.Table) -> pa.Table:
        """Corpus counts, twice, and one more for the first block that asks: it sees to the n-gram's context."""
        out = []
        for n, rows, distinct, first, back in in_part(asked):
            own = np.concatenate([_unpack(r["counts"], r["size"], np.int64) for r in rows])
            c = np.bincount(back, own, len(distinct)).astype(np.int64)
            if n == 1:
                words = c[distinct != _START_KEY]
                out.append({"block": -1, "n": 0, "part": rows[0]["part"], "size": 0, "data": b"",
                            "total": int(words.sum()), "distinct": int((words > 0).sum())})
            else:
                c[c < least] = 0
            values = 2 * c[back]
            values[first] += c > 0
            out += told(rows, values)
        return pa.Table.from_pylist(out, told_type)

    asked = stored.select("block", "sizes", "held", "data").mapInArrow(
        ask, "part long, block long, n long, size long, keys binary, counts binary")
    counted = settle_and_free(asked.groupBy("part").applyInArrow(add_up, as_told), "lm-counts")
    total, distinct = (x or 0 for x in counted.where("block < 0").agg(F.sum("total"), F.sum("distinct")).first())
    counted = counted.where("block >= 0").select("block", "n", "part", "size", "data")

    def block_of(texts_: pa.Table) -> tuple[dict, Block]:
        row = texts_.to_pylist()[0]
        return row, Block(row["sizes"], row["held"], row["data"], order)

    def contexts(texts_: pa.Table, answers: pa.Table) -> pa.Table:
        """Asks for contexts' weights; brings what this block's own n-grams add to them."""
        row, block = block_of(texts_)
        known = Known(block, answers.to_pylist(), least, total, distinct)
        out = []
        for n in range(1, order):
            some, keys = known.contexts[n - 1], block.keys[n - 1]
            mine = known.mine[n]
            prefix = known.prefix[n - 1][mine]
            here, shorter = known.counts[n][mine], known.counts[n - 1][known.suffix[n - 1][mine]]
            sums = np.stack([np.bincount(prefix, w, len(keys))[some].astype(np.int64) for w in (None, here, shorter)])
            sums[0] = 2 * sums[0] + known.falls[n - 1][some]
            for part, i, j in block.parts(n, parts, some):
                out.append({"part": part, "block": row["block"], "n": n, "size": j - i, "keys": _pack(_apart(keys[some][i:j])),
                            "sums": _pack(np.ascontiguousarray(sums[:, i:j]).ravel())})
        return pa.Table.from_pylist(out, pa.schema([
            (c, pa.int64() if c in ("part", "block", "n", "size") else pa.binary())
            for c in ("part", "block", "n", "size", "keys", "sums")]))

    def weigh(asked: pa.Table) -> pa.Table:
        out = []
        for _, rows, keys, _, back in in_part(asked):
            sums = np.concatenate([_unpack(r["sums"], 3 * r["size"], np.int64).reshape(3, -1) for r in rows], axis=1)
            falls = sums[0] & 1
            sums[0] >>= 1
            out += told(rows, np.stack([np.bincount(back, x, len(keys)).astype(np.int64)[back] * falls for x in sums]))
        return pa.Table.from_pylist(out, told_type)

    by_block = stored.groupBy("block")
    weights = by_block.cogroup(counted.groupBy("block")).applyInArrow(
        contexts, "part long, block long, n long, size long, keys binary, sums binary")
    weights = weights.groupBy("part").applyInArrow(weigh, as_told).select("block", "n", "part", "size", "data")
    answers = counted.withColumn("weight", F.lit(False)).union(weights.withColumn("weight", F.lit(True)))
    id_kind = dict(docs.dtypes)["doc_id"]

    def one(texts_: pa.Table, answers: pa.Table) -> pa.Table:
        row, block = block_of(texts_)
        rows = answers.to_pylist()
        known = Known(block, [r for r in rows if not r["weight"]], least, total, distinct)
        sums = block.answers([r for r in rows if r["weight"]], 3)
        block.where.clear()
        own = np.log10(known.p[0])[block.at[0]]
        own[block.firsts] = 0.0
        seen = known.counts[0][block.at[0]] > 0
        seen[block.firsts] = False
        arcs = Arcs(block, known, sums)
        del known, sums, rows
        of_texts = lambda x: np.add.reduceat(x, block.firsts)
        return pa.table({"doc_id": texts_.column("ids").combine_chunks().flatten(), "n_tokens": pa.array(block.lengths),
                         "n_known": pa.array(of_texts(seen.astype(np.int64))), "base_score": pa.array(of_texts(own)),
                         "score": pa.array(arcs.scores(block, stretch))})

    scored = by_block.cogroup(answers.groupBy("block")).applyInArrow(
        one, f"doc_id {id_kind}, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known",
                         F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score")
