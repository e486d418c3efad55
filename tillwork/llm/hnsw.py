"""A hierarchical navigable small-world graph over one shard's vectors, built and searched in batches.

Everything is arrays: a batch of vectors moves through the graph at once, each with a beam
of its own, so that a step costs a few array operations rather than one per vector.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np


class Graph:
    """Unit vectors by cosine. Level 0 holds all nodes with up to 2 * ``links`` neighbours, each
    level above about one node in ``links`` of the one below."""

    def __init__(self, exact: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]]):
        #: the vectors in double precision, for verifying, and in single, for finding one's way
        self.exact, self.vectors = exact, exact.astype(np.float32)
        #: per level: the nodes' rows (ascending), and their neighbours as rows, -1 where there are fewer
        self.levels = levels

    def dump(self) -> bytes:
        """The links alone; the vectors are kept beside them."""
        out = io.BytesIO()
        np.savez(out, **{f"{k}{i}": x.astype(np.int32) for i, lv in enumerate(self.levels) for k, x in zip("na", lv)})
        return out.getvalue()

    @classmethod
    def load(cls, exact: np.ndarray, blob: bytes) -> Graph:
        z = np.load(io.BytesIO(blob))
        return cls(exact, [(z[f"n{i}"].astype(np.int64), z[f"a{i}"].astype(np.int64)) for i in range(len(z.files) // 2)])

    def _beam(self, queries: np.ndarray, entry: np.ndarray, level: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` closest nodes a beam of that width reaches from ``entry``: rows and cosines, closest first."""
        nodes, near = self.levels[level]
        slot = np.full(len(self.vectors), -1)
        slot[nodes] = np.arange(len(nodes))
        many = len(queries)
        rows = np.full((many, width), -1)
        sims = np.full((many, width), -np.inf, np.float32)
        open_ = np.zeros((many, width), bool)
        seen = np.zeros((many, len(nodes)), bool)
        rows[:, 0], open_[:, 0] = entry, True
        sims[:, 0] = np.einsum("qd,qd->q", queries, self.vectors[entry])
        seen[np.arange(many), slot[entry]] = True
        active = np.arange(many)
        at_once = min(4, width)
        while len(active):
            # the closest nodes of each beam whose neighbours have not been looked at
            order = np.argsort(~open_[active], axis=1, kind="stable")[:, :at_once]
            chosen = np.take_along_axis(rows[active], order, 1)
            real = np.take_along_axis(open_[active], order, 1)
            open_[active[:, None], order] = False
            new = near[slot[np.where(real, chosen, nodes[0])]].reshape(len(active), -1)
            ok = (new >= 0) & np.repeat(real, near.shape[1], axis=1)
            at = slot[np.where(ok, new, nodes[0])]
            ok &= ~seen[active[:, None], at]
            seen[np.broadcast_to(active[:, None], at.shape)[ok], at[ok]] = True
            got = np.full(new.shape, -np.inf, np.float32)
            q, k = np.nonzero(ok)
            got[q, k] = np.einsum("nd,nd->n", queries[active[q]], self.vectors[new[q, k]])
            all_rows = np.concatenate([rows[active], new], axis=1)
            all_sims = np.concatenate([sims[active], got], axis=1)
            all_open = np.concatenate([open_[active], ok], axis=1)
            order = np.argsort(-all_sims, axis=1, kind="stable")
            all_rows, all_sims, all_open = (np.take_along_axis(x, order, 1) for x in (all_rows, all_sims, all_open))
            # a node that two of the chosen led to stands there twice, side by side
            twice = np.zeros(all_rows.shape, bool)
            twice[:, 1:] = (all_rows[:, 1:] == all_rows[:, :-1]) & np.isfinite(all_sims[:, 1:])
            if twice.any():
                all_sims[twice], all_open[twice] = -np.inf, False
                order = np.argsort(-all_sims, axis=1, kind="stable")
                all_rows, all_sims, all_open = (np.take_along_axis(x, order, 1) for x in (all_rows, all_sims, all_open))
            rows[active], sims[active], open_[active] = all_rows[:, :width], all_sims[:, :width], all_open[:, :width]
            active = active[open_[active].any(axis=1)]
        rows[~np.isfinite(sims)] = -1
        return rows, sims

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Greedily down from the top, then a beam on the lowest level."""
        entry = np.full(len(queries), self.levels[-1][0][0])
        for level in range(len(self.levels) - 1, 0, -1):
            entry = self._beam(queries, entry, level, 1)[0][:, 0]
        return self._beam(queries, entry, 0, width)


def _choose(vectors: np.ndarray, sims: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of each line's candidates (closest first), none closer to a chosen one than to the node."""
    chosen = np.full((len(rows), most), -1)
    count = np.zeros(len(rows), np.int64)
    for k in range(rows.shape[1]):
        line = np.flatnonzero((rows[:, k] >= 0) & (count < most))
        if not len(line):
            continue
        c = rows[line, k]
        to_chosen = np.einsum("nd,nmd->nm", vectors[c], vectors[chosen[line]])
        to_chosen[chosen[line] < 0] = -np.inf
        good = line[to_chosen.max(axis=1) < sims[line, k]]
        chosen[good, count[good]] = rows[good, k]
        count[good] += 1
    # room that is left goes to the closest others, which keeps dense groups connected
    for k in range(rows.shape[1]):
        line = np.flatnonzero((rows[:, k] >= 0) & (count < most))
        line = line[~(chosen[line] == rows[line, k][:, None]).any(axis=1)]
        chosen[line, count[line]] = rows[line, k]
        count[line] += 1
    return chosen


def build(vectors: np.ndarray, seed: int, links: int = 12, width: int = 48, batch: int = 256) -> Graph:
    """Inserts the vectors in batches: each is linked to what a beam finds among earlier ones, and to
    the closest of its own batch, and those link back."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    level_of = np.floor(-np.log(rng.random(n)) / np.log(links)).astype(int)
    order = rng.permutation(n)
    top = int(level_of.max())
    members = [np.sort(np.flatnonzero(level_of >= lv)) for lv in range(top + 1)]
    places = [np.full(n, -1) for _ in members]
    for lv, m in enumerate(members):
        places[lv][m] = np.arange(len(m))
    near = [np.full((len(m), 2 * links if lv == 0 else links), -1) for lv, m in enumerate(members)]
    graph = Graph(vectors, list(zip(members, near, strict=True)))
    vectors = graph.vectors
    entry, entry_level = -1, -1
    done = 0
    while done < n:
        part = order[done:done + min(batch, max(1, done))]
        done += len(part)
        found = np.full(len(part), entry)
        among = vectors[part] @ vectors[part].T
        np.fill_diagonal(among, -np.inf)
        for lv in range(max(entry_level, int(level_of[part].max())), -1, -1):
            here = np.flatnonzero(level_of[part] >= lv)
            rows = np.full((len(part), width), -1)
            sims = np.full((len(part), width), -np.inf, np.float32)
            if lv <= entry_level:
                if len(here):
                    rows[here], sims[here] = graph._beam(vectors[part[here]], found[here], lv, width)
                rest = np.setdiff1d(np.arange(len(part)), here)
                if len(rest) and lv:
                    rows[rest, :1], sims[rest, :1] = graph._beam(vectors[part[rest]], found[rest], lv, 1)
                found = np.where(rows[:, 0] >= 0, rows[:, 0], found)
            if not len(here):
                continue
            own = among[np.ix_(here, here)]
            k = min(links, len(here))
            closest = np.argsort(-own, axis=1)[:, :k]
            own_sims = np.take_along_axis(own, closest, 1)
            own_rows = np.where(np.isfinite(own_sims), part[here][closest], -1)
            all_rows = np.concatenate([rows[here], own_rows], axis=1)
            all_sims = np.concatenate([sims[here], own_sims], axis=1)
            rank = np.argsort(-all_sims, axis=1, kind="stable")
            chosen = _choose(vectors, np.take_along_axis(all_sims, rank, 1), np.take_along_axis(all_rows, rank, 1), links)
            adj = near[lv]
            adj[places[lv][part[here]], :links] = chosen
            # and back: whoever was chosen takes the new node too, and sheds what is too much
            source = np.repeat(part[here], links)[chosen.ravel() >= 0]
            target = chosen.ravel()[chosen.ravel() >= 0]
            if not len(target):
                continue
            by = np.argsort(target, kind="stable")
            target, source = target[by], source[by]
            hubs, first, counts = np.unique(target, return_index=True, return_counts=True)
            extra = np.full((len(hubs), int(counts.max())), -1)
            extra[np.repeat(np.arange(len(hubs)), counts), np.arange(len(target)) - np.repeat(first, counts)] = source
            both = np.concatenate([adj[places[lv][hubs]], extra], axis=1)
            for c in range(adj.shape[1], both.shape[1]):  # a node of the same batch may be there already
                both[(both[:, :c] == both[:, c][:, None]).any(axis=1), c] = -1
            s = np.einsum("nd,nmd->nm", vectors[hubs], vectors[both])
            s[both < 0] = -np.inf
            rank = np.argsort(-s, axis=1, kind="stable")
            both, s = np.take_along_axis(both, rank, 1), np.take_along_axis(s, rank, 1)
            adj[places[lv][hubs]] = _choose(vectors, s, both, adj.shape[1])
        new_top = part[np.argmax(level_of[part])]
        if level_of[new_top] > entry_level:
            entry, entry_level = int(new_top), int(level_of[new_top])
    # searches begin at the first node of the highest level
    return graph


def _spread(graph: Graph, queries: np.ndarray, rows: np.ndarray, loose: np.float32, expand: np.float32,
            most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From what beams found, along all links of nodes at ``expand`` or more: (query, node) at ``loose``
    or more, and the queries that met over ``most`` such nodes, whose pairs are left out."""
    near, n, many = graph.levels[0][1], len(graph.vectors), len(queries)
    seen = np.zeros(many * n, bool)
    met, wide = np.zeros(many, np.int64), np.zeros(many, bool)
    q, k = np.nonzero(rows >= 0)
    new = np.unique(q * n + rows[q, k])
    pairs = []
    while len(new):
        seen[new] = True
        q, r = np.divmod(new, n)
        sims = np.concatenate([np.einsum("nd,nd->n", queries[q[a:a + 200_000]], graph.vectors[r[a:a + 200_000]])
                               for a in range(0, len(q), 200_000)])
        pairs.append(new[sims >= loose])
        q, r = q[sims >= expand], r[sims >= expand]
        met += np.bincount(q, minlength=many)
        wide = met > most
        q, r = q[~wide[q]], r[~wide[q]]
        ahead = []
        for a in range(0, len(q), 100_000):
            there = near[r[a:a + 100_000]]
            keys = (q[a:a + 100_000, None] * n + there)[there >= 0]
            ahead.append(np.unique(keys[~seen[keys]]))
        new = np.unique(np.concatenate(ahead)) if ahead else np.array([], np.int64)
    q, r = np.divmod(np.concatenate(pairs) if pairs else np.array([], np.int64), n)
    return q[~wide[q]], r[~wide[q]], np.flatnonzero(wide)


def search_links(graph: Graph, exact: np.ndarray, least: float, width: int,
                 block: int = 1024) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query, node) pairs with cosine >= least that the graph gives, verified in double precision, by
    blocks of queries; and which queries of the block were held against all nodes.

    Where a beam ends above ``least`` the verified neighbourhood is larger than the beam: it is followed
    along the graph, over nodes a little below ``least`` too. A query with over a 32nd of all
    nodes around it goes through all of them, which is then less work.
    """
    n, loose = len(graph.vectors), np.float32(least - 1e-3)
    expand = np.float32(max(least - 0.02 * width / 16, -1.0))
    size = max(1, min(block, 32_000_000 // max(n, 16 * width)))
    for at in range(0, len(exact), size):
        queries = exact[at:at + size].astype(np.float32)
        through = np.arange(len(queries))
        parts = []
        if width < n:
            rows, sims = graph.search(queries, width)
            full = np.flatnonzero(sims[:, -1] >= loose)
            q, k = np.nonzero(sims >= loose)
            alone = ~np.isin(q, full)
            parts.append((q[alone], rows[q[alone], k[alone]]))
            q, r, wide = _spread(graph, queries[full], rows[full], loose, expand, max(n // 32, width))
            parts.append((full[q], r))
            through = full[wide]
        step = max(1, 16_000_000 // n)
        for a in range(0, len(through), step):  # a few at a time: a dense group has very many pairs
            q, r = np.nonzero(queries[through[a:a + step]] @ graph.vectors.T >= loose)
            q = through[a:a + step][q]
            sure = np.einsum("nd,nd->n", exact[at + q], graph.exact[r]) >= least
            yield at + q[sure], r[sure], at + through[a:a + step]
        for q, r in parts:
            sure = np.einsum("nd,nd->n", exact[at + q], graph.exact[r]) >= least
            yield at + q[sure], r[sure], np.array([], np.int64)


def audited_width(graph: Graph, exact: np.ndarray, least: float, same: bool, width: int = 32, recall: float = 0.99,
                  pairs: int = 50, most: int = 2048) -> tuple[int, float, int]:
    """The beam width at which an audit passes, its recall, and the true pairs it was judged on.

    Queries spread over all are held against all nodes, ever more of them until ``pairs`` true pairs
    of two vectors are seen or ``most`` queries were held; of these pairs the graph has to give the share ``recall``, else beams
    are doubled, up to the width of the shard, which is a comparison with all nodes.
    """
    count, truth = 32, set()
    while True:
        sample = np.unique(np.linspace(0, len(exact) - 1, min(count, len(exact))).astype(int))
        truth = set()
        for a in range(0, len(sample), 256):
            q, r = np.nonzero(exact[sample[a:a + 256]] @ graph.exact.T >= least)
            q = q + a
            other = sample[q] != r if same else np.ones(len(q), bool)
            truth.update(zip(q[other].tolist(), r[other].tolist()))
        if len(truth) >= pairs or len(sample) == len(exact) or count >= most:
            break
        count *= 4
    while True:
        found = {p for q, r, _ in search_links(graph, exact[sample], least, width) for p in zip(q.tolist(), r.tolist())}
        reached = len(found & truth) / len(truth) if truth else 1.0
        if reached >= recall or width >= len(graph.vectors):
            return width, reached, len(truth)
        width *= 2


def links_between(graph: Graph, exact: np.ndarray, least: float, recall: float = 0.99) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified pairs (asking vector, node) of two shards, each once."""
    width, _, _ = audited_width(graph, exact, least, False, recall=recall)
    for q, r, _ in search_links(graph, exact, least, width):
        yield q, r


def links_within(graph: Graph, least: float, recall: float = 0.99) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified pairs of a shard's own vectors, in both directions whichever end found them.

    Vectors held against all nodes are certain of their pairs, which pass at once; of the others'
    pairs both directions are kept until the end, each once.
    """
    n = len(graph.vectors)
    width, _, _ = audited_width(graph, graph.exact, least, True, recall=recall)
    certain, kept, size = np.zeros(n, bool), [], 0
    for q, r, through in search_links(graph, graph.exact, least, width):
        q, r = q[q != r], r[q != r]
        certain[through] = True
        if len(through):
            yield q, r
        kept.append(np.concatenate([r * n + q, q * n + r] if not len(through) else [r * n + q]))
        size += len(kept[-1])
        if size > 4_000_000:
            kept = [np.unique(np.concatenate(kept))]
            kept[0] = kept[0][~certain[kept[0] // n]]
            size = len(kept[0])
    q, r = np.divmod(np.unique(np.concatenate(kept)) if kept else np.array([], np.int64), n)
    yield q[~certain[q]], r[~certain[q]]
