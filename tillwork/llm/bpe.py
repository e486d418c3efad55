"""Byte-level BPE by replaying the merges over a block of the corpus at once."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from tillwork.llm.common import blocks, held, texts

#: Pieces a worker remembers before it forgets all of them and starts anew.
REMEMBERED = 250_000
#: Characters of one block of the replay, about; a text is never cut.
BLOCK_CHARS = 6_000_000


def ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a tiktoken rank file. Workers and driver read their installed copy."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """The vocabulary as a table from pairs of tokens to the token they become."""

    def __init__(self, rank_of: dict[bytes, int]):
        self.rank_of = rank_of
        self.bytes_of = {r: b for b, r in rank_of.items()}
        self.single = np.array([rank_of[bytes([b])] for b in range(256)], np.int64)
        pairs = [(rank_of[t[:i]], rank_of[t[i:]], r) for t, r in rank_of.items()
                 for i in range(1, len(t)) if t[:i] in rank_of and t[i:] in rank_of]
        left, right, made = np.array(pairs, np.int64).T
        order = np.argsort(left << 32 | right)
        self.keys, self.made = (left << 32 | right)[order], made[order]

    def of(self, left, right) -> np.ndarray:
        """What each pair becomes, -1 where it is no token."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], -1)


def replay(pieces: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray, dict[int, list[int]]]:
    """All pieces' token ids in one array, how many each has, and the ids of pieces taken out.

    The pieces lie one after another in one array, each position linked to its neighbours.
    ``places`` is an inverted index from a pair, named by the rank of the token it becomes, to
    the positions of its left halves. Ranks come off a heap in order; all places of a rank that
    still hold its pair are merged at once, and only the pairs to their left and right are
    looked up and entered anew.

    Merging all places at once is what one piece by itself would do, unless places overlap
    (``aaa``) or a merge makes a pair of lower rank (a vocabulary may hold a token whose
    part was learned later). Such pieces are taken out and replayed by ``_alone``;
    what the array holds for them does not count.
    """
    sizes = np.array([len(p) for p in pieces], np.int64)
    n = int(sizes.sum())
    ends = np.cumsum(sizes)
    piece_of = np.repeat(np.arange(len(pieces)), sizes)
    tok = merges.single[np.frombuffer(b"".join(pieces), np.uint8)]
    nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
    nxt[ends - 1], prv[ends - sizes] = -1, -1
    pair = np.full(n, -1)
    inner = np.flatnonzero(nxt >= 0)
    pair[inner] = merges.of(tok[inner], tok[inner + 1])

    places: dict[int, list[np.ndarray]] = defaultdict(list)
    heap: list[int] = []

    def enter(at: np.ndarray) -> None:
        r = pair[at]
        at, r = at[r >= 0], r[r >= 0]
        if len(at):
            order = np.argsort(r, kind="stable")
            at, r = at[order], r[order]
            cuts = np.flatnonzero(np.diff(r)) + 1
            edges = [0, *cuts.tolist(), len(at)]
            for rank, lo, hi in zip(r[edges[:-1]].tolist(), edges, edges[1:]):
                if rank not in places:
                    heapq.heappush(heap, rank)
                places[rank].append(at[lo:hi])

    apart: set[int] = set()

    def take_out(at: np.ndarray) -> None:
        for p in set(piece_of[at].tolist()) - apart:
            apart.add(p)
            pair[ends[p] - sizes[p]:ends[p]] = -1

    enter(inner)
    while heap:
        rank = heapq.heappop(heap)
        groups = places.pop(rank)
        at = groups[0] if len(groups) == 1 else np.concatenate(groups)
        at = at[pair[at] == rank]
        right = nxt[at]
        if (overlap := pair[right] == rank).any():
            take_out(at[overlap])
            keep = pair[at] == rank
            at, right = at[keep], right[keep]
        beyond = nxt[right]
        has = beyond >= 0
        # a pair that exists only between two merges of this rank that stand side by side
        if (side := has & (pair[beyond] == rank)).any():
            between = merges.of(np.full(int(side.sum()), rank), tok[beyond[side]])
            if ((between >= 0) & (between < rank)).any():
                take_out(at[side][(between >= 0) & (between < rank)])
                keep = pair[at] == rank
                at, right, beyond, has = at[keep], right[keep], beyond[keep], has[keep]
        if not len(at):
            continue
        tok[at], tok[right], pair[right], nxt[at] = rank, -1, -1, beyond
        prv[beyond[has]] = at[has]
        pair[at] = -1
        here, there = at[has], beyond[has]
        pair[here] = merges.of(tok[here], tok[there])
        left = prv[at]
        left = left[left >= 0]
        pair[left] = merges.of(tok[left], tok[nxt[left]])
        touched = np.concatenate([here, left])
        if len(touched) > 1:
            touched = np.unique(touched)
        if ((lower := pair[touched]) < rank).any() and (low := (lower >= 0) & (lower < rank)).any():
            take_out(touched[low])
        enter(touched)

    live = tok >= 0
    counts = np.bincount(piece_of[live], minlength=len(pieces))
    return tok[live], counts, {p: _alone(pieces[p], merges.rank_of) for p in apart}


def _alone(piece: bytes, rank_of: dict[bytes, int]) -> list[int]:
    """One piece's merges by (rank, position) from a heap."""
    token: list[bytes | None] = [piece[i:i + 1] for i in range(len(piece))]
    before, after = list(range(-1, len(piece) - 1)), [*range(1, len(piece)), -1]
    heap: list[tuple[int, int]] = []

    def enter(i: int) -> None:
        if i >= 0 and after[i] >= 0 and (r := rank_of.get(token[i] + token[after[i]])) is not None:
            heapq.heappush(heap, (r, i))

    for i in range(len(piece)):
        enter(i)
    while heap:
        rank, i = heapq.heappop(heap)
        if token[i] is None or after[i] < 0 or rank_of.get(token[i] + token[after[i]]) != rank:
            continue
        j = after[i]
        token[i], token[j], after[i] = token[i] + token[j], None, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        enter(i)
        enter(before[i])
    return [rank_of[t] for t in token if t is not None]


def _plain_pattern() -> re.Pattern:
    """The production pattern over code points below U+0250, whose classes are listed one by one."""
    kinds = {k: "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
    space = "\t-\r \x85\xa0"
    plain = public_tokenizers.PATTERN.replace(r"\p{L}+", f"[{kinds['L']}]+").replace(r"\p{N}+", f"[{kinds['N']}]+")
    plain = plain.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{kinds['L']}{kinds['N']}]")
    return re.compile(plain.replace(r"\S", f"[^{space}]").replace(r"\s", f"[{space}]"))


class Encoder:
    """Encodes blocks of texts; remembers the pieces it has replayed, up to ``REMEMBERED``."""

    def __init__(self, path: str, pattern: str):
        self.merges = Merges(ranks(path))
        # White space here is Unicode's property, as in the tokenizer's own pattern engine.
        self.split = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
                                   .replace(r"\S", r"\P{White_Space}")).findall
        # The same cuts by a quicker engine, for texts of Latin letters only.
        self.plain = _plain_pattern().findall if pattern == public_tokenizers.PATTERN else None
        self.beyond = re.compile("[^\x00-\u024f]").search
        self.ids: dict[str, str] = {}  # piece -> its ids in decimal
        self.out: dict[str, bytes] = {}  # piece -> the bytes that these decode to

    def pieces(self, text: str) -> list[str]:
        return self.split(text) if self.plain is None or self.beyond(text) else self.plain(text)

    def learn(self, new: list[str]) -> None:
        rank_of, bytes_of = self.merges.rank_of, self.merges.bytes_of
        rest, raw = [], []
        for p in new:
            b = p.encode()
            # a piece that is itself a token is that token, whatever its merges would give
            if (r := rank_of.get(b)) is not None:
                self.ids[p], self.out[p] = str(r), bytes_of[r]
            else:
                rest.append(p)
                raw.append(b)
        if rest:
            ids, counts, apart = replay(raw, self.merges)
            ids = ids.tolist()
            words, parts = list(map(str, ids)), [bytes_of[i] for i in ids]
            ends = np.cumsum(counts).tolist()
            starts = [0, *ends[:-1]]
            self.ids.update(zip(rest, [" ".join(words[a:b]) for a, b in zip(starts, ends)]))
            self.out.update(zip(rest, [b"".join(parts[a:b]) for a, b in zip(starts, ends)]))
            for k, found in apart.items():
                self.ids[rest[k]] = " ".join(map(str, found))
                self.out[rest[k]] = b"".join([bytes_of[i] for i in found])

    def encode(self, block: list[str]) -> Iterator[tuple[str, bytes]]:
        """Per text, its ids in decimal joined by spaces, and the bytes they decode to."""
        if len(self.ids) > REMEMBERED:
            self.ids.clear()
            self.out.clear()
        pieces = [self.pieces(t) for t in block]
        new: set[str] = set()
        for ps in pieces:
            new.update(ps)
        self.learn(list(new.difference(self.ids)))
        ids, out = self.ids.__getitem__, self.out.__getitem__
        for ps in pieces:
            yield " ".join(map(ids, ps)), b"".join(map(out, ps))


def tokenize(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
             keep_ids: bool = False) -> DataFrame:
    """Encodes and decodes every text: doc_id, n_tokens, ids_sha256, decoded_sha256[, ids].

    ``ids_sha256`` is of the decimal ids joined by one space, ``decoded_sha256`` of the bytes
    that the ids decode to. No special tokens; their names are ordinary text. A null text is
    the empty text: no ids. Null and repeated doc_ids are rows like others, other columns are
    not read. The corpus is replayed in blocks of documents, which changes no result, since
    merges stay inside a piece; a text is never cut.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = held(f"bpe {path} {pattern}", lambda: Encoder(path, pattern))
        for batch in batches:
            found = texts(batch)
            for start, end in blocks(found, BLOCK_CHARS):
                coded = list(coder.encode(found[start:end]))
                columns = [batch.column("doc_id").slice(start, end - start),
                           pa.array([ids.count(" ") + 1 if ids else 0 for ids, _ in coded], pa.int64()),
                           pa.array([hashlib.sha256(ids.encode()).hexdigest() for ids, _ in coded]),
                           pa.array([hashlib.sha256(out).hexdigest() for _, out in coded])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    columns.append(pa.array([list(map(int, ids.split())) for ids, _ in coded], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema + (", ids array<int>" if keep_ids else ""))
