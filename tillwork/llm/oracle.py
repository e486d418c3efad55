"""What SQL can express of the corpus queries, for DuckDB over the same tables."""

from __future__ import annotations

from tillwork.llm.sharding import EIGHT, Tree, with_region


def _draw(key: str, path: str, children: str) -> str:
    """The child (name, weight) with the smallest -ln(u) / weight, u from an md5 of key, path and name."""
    bits = f"CAST('0x' || substr(md5({key} || {path} || '/' || c.n), 1, 13) AS BIGINT)"
    return (f"list_sort(list_transform({children}, lambda c: "
            f"{{'s': -ln((CAST({bits} AS DOUBLE) + 0.5) / 4503599627370496.0) / c.w, 'n': c.n}}))[1].n")


def _nodes(pairs: list[tuple[str, float]]) -> str:
    return "[" + ", ".join(f"{{'n': '{n}', 'w': {w}}}" for n, w in pairs) + "]"


def _case(of: str, entries: dict[str, str]) -> str:
    return f"CASE {of} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in entries.items()) + " END"


def _descend(tree: Tree, source: str, name: str) -> str:
    weight = lambda node: sum(map(weight, node.values())) if isinstance(node, dict) else node
    regions = _nodes([(r, weight(v)) for r, v in tree.items()])
    racks = {r: _nodes([(k, weight(v)) for k, v in ks.items()]) for r, ks in tree.items()}
    shards = {f"{r}/{k}": _nodes([(str(s), w) for s, w in ss.items()]) for r, ks in tree.items() for k, ss in ks.items()}
    return f"""SELECT *, CAST({_draw("k", "'/' || rack", _case("rack", shards))} AS INT) AS {name} FROM (
        SELECT *, region || '/' || {_draw("k", "'/' || region", _case("region", racks))} AS rack FROM (
        SELECT * EXCLUDE (region, rack), {_draw("k", "''", regions)} AS region FROM {source}))"""


# CRC-32 over the bytes of the text, its table made from the polynomial
_CRC = """xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, 2 * strlen(t), 2),
    lambda i: CAST('0x' || substr(x, CAST(i AS INT), 2) AS UBIGINT))),
    lambda a, b: xor(a >> 8, crc_table[CAST(xor(a, b) & 255 AS INT) + 1])), 4294967295::UBIGINT)"""

_CRC_TABLE = """crc AS (SELECT list(list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]),
        lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) ORDER BY i) AS crc_table
      FROM range(256) r(i))"""

SHARDS = f"""WITH {_CRC_TABLE},
    docs AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS k, coalesce(text, '') AS t FROM documents),
    sized AS (SELECT doc_id, k, CAST(strlen(t) + 1 AS BIGINT) AS size, CAST({_CRC} AS BIGINT) AS text_crc32,
        '' AS region, '' AS rack FROM (SELECT *, hex(encode(t)) AS x FROM docs), crc),
    placed AS ({_descend(EIGHT, "sized", "shard")}),
    grown AS ({_descend(with_region(EIGHT, 8), "placed", "grown_shard")})
SELECT doc_id, size, text_crc32, 'key' AS law, shard, CAST(row_number() OVER (PARTITION BY shard
    ORDER BY md5(k), size, text_crc32) - 1 AS BIGINT) AS slot, grown_shard FROM grown"""


def _manifest(levels: int = 34) -> str:
    """A level a step, up to 2 ** levels leaves: nodes, and each leaf's folded digest and proof so far."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda chars: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", chars, "text"))) + ")"
    where = lambda name, step: f"""{name}{step} AS MATERIALIZED (SELECT tree, idx // 2 AS idx, (n + 1) // 2 AS n,
        CASE WHEN n = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY idx)) END AS node
      FROM {name}{step - 1} GROUP BY tree, idx // 2, n)"""  # noqa: E731
    folds = lambda rows, name, step: f"""{rows}{step} AS MATERIALIZED (SELECT r.* REPLACE (r.idx // 2 AS idx, r.proof || coalesce(s.node, '') AS proof,
        CASE WHEN s.node IS NOT NULL THEN sha256(CASE WHEN r.idx % 2 = 0 THEN r.cur || s.node ELSE s.node || r.cur END)
             WHEN r.n > 1 THEN sha256(r.cur) ELSE r.cur END AS cur, (r.n + 1) // 2 AS n)
      FROM {rows}{step - 1} r LEFT JOIN {name}{step - 1} s ON s.tree IS NOT DISTINCT FROM r.tree AND s.idx = xor(r.idx, 1::BIGINT) AND r.n > 1)"""  # noqa: E731
    ctes = [_CRC_TABLE, f"""docs AS (SELECT *, {leaf("n_chars")} AS leaf, {leaf("CAST(n_chars AS HUGEINT) + 1")} AS forged,
        CAST(doc_id AS VARCHAR) AS t, hex(encode(CAST(doc_id AS VARCHAR))) AS x FROM documents)""",
        f"""leaves AS MATERIALIZED (SELECT doc_id, lang AS tree, leaf, CASE WHEN {_CRC} % 7 = 0 THEN forged ELSE leaf END AS cur, '' AS proof,
        row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM docs, crc)""",
        "a0 AS MATERIALIZED (SELECT tree, idx, n, leaf AS node FROM leaves)", "p0 AS (SELECT * FROM leaves)"]
    for step in range(1, levels + 1):
        ctes += [where("a", step), folds("p", "a", step)]
    ctes += [f"""b0 AS MATERIALIZED (SELECT 0 AS tree, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS idx,
        count(*) OVER () AS n, node FROM a{levels})""",
             f"""q0 AS (SELECT p.doc_id, p.leaf, s.node AS subroot, p.cur, p.proof, 0 AS tree, s.idx, s.n FROM p{levels} p
        JOIN (SELECT tree AS lang, node, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
              FROM a{levels}) s ON s.lang IS NOT DISTINCT FROM p.tree)"""]
    for step in range(1, levels + 1):
        ctes += [where("b", step), folds("q", "b", step)]
    return "WITH " + ",\n".join(ctes) + f"""
SELECT q.doc_id, q.leaf, q.subroot, r.node AS root, sha256(q.proof) AS proof_sha256, q.cur AS folded_root, q.cur = r.node AS verified
FROM q{levels} q, b{levels} r"""


# control strings get a backslash behind their first character, backslashes are doubled
_GUARD = r"""regexp_replace(replace({}, '\', '\\'), '(<)(s>|/s>)|(\[)(/?(?:INST|ROLE)\])', '\1\3\\\2\4', 'g')"""

_TURN = "md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))"

CHAT = f"""WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, {_TURN} AS tie FROM (
      SELECT conv_id, turn, role, text FROM conversations UNION ALL
      SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')),
    shown AS (SELECT *, CASE role WHEN 'user' THEN '[INST] ' || {_GUARD.format("text")} || ' [/INST]'
        WHEN 'assistant' THEN {_GUARD.format("text")} || '</s>'
        ELSE '[ROLE]' || {_GUARD.format("role")} || '[/ROLE]' || {_GUARD.format("text")} || '</s>' END AS formatted FROM turns)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, tie)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, tie) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(3 + sum(length(formatted)) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id"""

TRIE = f"""WITH {_CRC_TABLE},
    turns AS MATERIALIZED (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_TURN}) - 1 AS p, count(*) OVER (PARTITION BY conv_id) AS n
      FROM conversations WHERE conv_id IS NOT NULL),
    convs AS MATERIALIZED (SELECT c, c - c % 5 AS b, n, CAST({_CRC} % 9 AS BIGINT) AS h FROM (
        SELECT DISTINCT c, n, CAST(c AS VARCHAR) AS t, hex(encode(CAST(c AS VARCHAR))) AS x FROM turns), crc),
    built AS (SELECT v.c, t.p + 1 AS d, t.role, t.text FROM convs v JOIN turns t ON t.c = v.b AND t.p < v.h
        UNION ALL SELECT v.c, t.p - v.h + least(v.h, coalesce(b.n, 0)) + 1, t.role, t.text
        FROM convs v JOIN turns t ON t.c = v.c AND t.p >= v.h LEFT JOIN convs b ON b.c = v.b),
    steps AS (SELECT c, d, strlen(text) AS bytes, max(d) OVER (PARTITION BY c) AS len,
        string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '')
            OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS prefix FROM built),
    places AS MATERIALIZED (SELECT c, d, bytes, len, sha256(prefix) AS k FROM steps
        UNION ALL SELECT v.c, 0, 0, coalesce(l.len, 0), '' FROM convs v LEFT JOIN (SELECT c, max(len) AS len FROM steps GROUP BY c) l ON l.c = v.c),
    grouped AS MATERIALIZED (SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
        sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (d = len), '')) AS ends_sha256 FROM places GROUP BY k, d),
    parents AS (SELECT g.k, up.k AS parent, p.conv_id AS parent_conv_id FROM grouped g
        JOIN places up ON up.c = g.conv_id AND up.d = g.d - 1 JOIN grouped p ON p.k = up.k AND p.d = up.d),
    kids AS MATERIALIZED (SELECT parent AS k, count(*) AS n_children FROM parents GROUP BY parent),
    below AS (SELECT up.k, up.d, count(*) FILTER (kids.k IS NULL) AS n_leaves, sum((g.n_convs - 1) * g.bytes) AS saved_tokens
      FROM grouped g LEFT JOIN kids ON kids.k = g.k JOIN places up ON up.c = g.conv_id AND up.d <= g.d GROUP BY up.k, up.d)
SELECT g.conv_id, CAST(g.d AS BIGINT) AS depth, parents.parent_conv_id, g.n_convs, coalesce(kids.n_children, 0) AS n_children,
    below.n_leaves, CAST(below.saved_tokens AS BIGINT) AS saved_tokens, g.ends_sha256
FROM grouped g JOIN below ON below.k = g.k AND below.d = g.d LEFT JOIN parents ON parents.k = g.k LEFT JOIN kids ON kids.k = g.k"""

ORACLE = {"op8_hash_tree": SHARDS, "op11_prefix_trie": TRIE, "op12_merkle_manifest": _manifest(), "op13_chat_template": CHAT}
