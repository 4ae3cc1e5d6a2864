"""SQL of the registered queries where DuckDB can say the same, beside that of ``catalogue``."""

from __future__ import annotations

#: CRC-32 by its table of 256 entries, which the polynomial gives.
_CRC = """
bits(i, c, k) AS (
    SELECT i, i, 0 FROM (SELECT unnest(range(256))::BIGINT AS i)
    UNION ALL
    SELECT i, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), k + 1 FROM bits WHERE k < 8
),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
bytes(name, acc, rest) AS (
    SELECT name, 4294967295::BIGINT, name FROM names
    UNION ALL
    SELECT name, xor(acc >> 8, t[(xor(acc, ascii(rest)) & 255) + 1]), rest[2:] FROM bytes, crc WHERE rest <> ''
),
sums AS (SELECT name, xor(acc, 4294967295) AS crc FROM bytes WHERE rest = '')
"""


def _field(name: str) -> str:
    return f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR), '-')"


MANIFEST = rf"""
WITH RECURSIVE names AS (SELECT DISTINCT CAST(doc_id AS VARCHAR) AS name FROM documents WHERE doc_id IS NOT NULL),
{_CRC},
fields AS (
    SELECT doc_id, source, concat({_field("doc_id")}, {_field("source")}, {_field("lang")}, {_field("n_chars")}) AS head, text,
           CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS after
    FROM documents d LEFT JOIN sums ON name = CAST(doc_id AS VARCHAR)
),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n
    FROM (SELECT doc_id, source, sha256(head || {_field("text")}) AS leaf, sha256(head || {_field("after")}) AS changed FROM fields)
),
tree(source, level, idx, n, digest) AS (
    SELECT source, 0, idx, n, leaf FROM leaves
    UNION ALL
    SELECT source, level + 1, idx // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY idx))
    FROM tree WHERE n > 1 GROUP BY source, level, idx // 3
),
subroots AS (
    SELECT source, level AS height, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
    FROM tree WHERE n = 1
),
top(level, idx, n, digest) AS (
    SELECT 0, place, n, subroot FROM subroots
    UNION ALL
    SELECT level + 1, idx // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY level, idx // 3
),
placed AS (SELECT l.*, place, height, subroot FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source),
runs AS (
    SELECT place, level, t.idx // 3 AS run, list(t.digest ORDER BY t.idx) AS members
    FROM tree t JOIN subroots s ON t.source IS NOT DISTINCT FROM s.source WHERE t.n > 1 GROUP BY ALL
),
top_runs AS (SELECT level, idx // 3 AS run, list(digest ORDER BY idx) AS members FROM top WHERE n > 1 GROUP BY ALL),
ways AS (
    SELECT l.idx, l.place, level AS step, members, (l.idx // (3 ** level)::BIGINT) % 3 AS spot
    FROM placed l JOIN runs r ON r.place = l.place AND r.run = l.idx // (3 ** (level + 1))::BIGINT
    UNION ALL
    SELECT l.idx, l.place, height + level, members, (l.place // (3 ** level)::BIGINT) % 3
    FROM placed l JOIN top_runs r ON r.run = l.place // (3 ** (level + 1))::BIGINT
),
steps AS (SELECT place, idx, step, array_to_string(members[1:spot], '') AS lft, array_to_string(members[spot + 2:3], '') AS rgt FROM ways),
fold(place, idx, step, digest) AS (
    SELECT place, idx, 0, changed FROM placed
    UNION ALL
    SELECT f.place, f.idx, f.step + 1, sha256(lft || digest || rgt)
    FROM fold f JOIN steps s ON f.place = s.place AND f.idx = s.idx AND f.step = s.step
),
folds AS (SELECT place, idx, arg_max(digest, step) AS folded_root FROM fold GROUP BY ALL),
proofs AS (SELECT place, idx, string_agg(lft || rgt, '' ORDER BY step) AS proof FROM steps GROUP BY ALL)
SELECT l.doc_id, l.leaf, l.subroot, top.digest AS root, sha256(coalesce(proof, '')) AS proof_sha256, folded_root, folded_root = top.digest AS verified
FROM placed l JOIN top ON top.n = 1 JOIN folds f ON f.place = l.place AND f.idx = l.idx LEFT JOIN proofs p ON p.place = l.place AND p.idx = l.idx
"""


def _after(state: str, cost: str, edit: str, out: str) -> str:
    """A state's best (cost, audit, text) after one more edit; null where there is none."""
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}['c'] + {cost}, 'k': {state}['k'] || '{edit}', 'o': {out}}} END"


def _said(state: str, role: str, text: str, first: bool = False) -> str:
    return f"{role} || ':' || {text}" if first else f"{state}['o'] || chr(10) || {role} || ':' || {text}"


def _inserted(source: str) -> str:
    """Columns e, s, u, a (empty, after system, after user, after assistant) with insertions made."""
    to_u = ", ".join(["u", _after("e", "2", "I", _said("e", "'user'", "''", True)), *(_after(q, "2", "I", _said(q, "'user'", "''")) for q in "sa")])
    to_a = f"a, {_after('u', '2', 'I', _said('u', chr(39) + 'assistant' + chr(39), chr(39) * 2))}"
    return f"SELECT * REPLACE (list_min([{to_a}]) AS a) FROM (SELECT * REPLACE (list_min([{to_u}]) AS u) FROM ({source}))"


def _read() -> str:
    """Columns e, s, u, a after one more turn (role, text, must_go, broken)."""
    ways = {q: [_after(q, "3", "D", f"{q}['o']")] for q in "esua"}
    for q, target, letter in (("e", "s", "s"), ("e", "u", "u"), ("s", "u", "u"), ("a", "u", "u"), ("u", "a", "a")):
        kept = _after(q, "broken", "K", _said(q, "role", "text", q == "e"))
        ways[target].append(f"CASE WHEN NOT must_go AND role[1] = '{letter}' THEN {kept} END")
        if letter != "s":
            role = "'user'" if letter == "u" else "'assistant'"
            ways[target].append(f"CASE WHEN NOT must_go THEN {_after(q, '2 + broken', 'R', _said(q, role, 'text', q == 'e'))} END")
    return ", ".join(f"list_min([{', '.join(ways[q])}]) AS {q}" for q in "esua")


_KEY = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
_BEST = "{'c': 0::BIGINT, 'k': '', 'o': ''}"
_TYPE = "STRUCT(c BIGINT, k VARCHAR, o VARCHAR)"

ROLE_REPAIR = rf"""
WITH RECURSIVE names AS (SELECT DISTINCT {_KEY} AS name FROM conversations),
{_CRC},
faulty AS (
    SELECT conv_id, turn, crc % 20 AS fault, CASE WHEN crc % 20 = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
           CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text
    FROM conversations JOIN sums ON name = {_KEY}
),
turns AS (
    SELECT conv_id, turn, role, text, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM faulty WHERE fault <> 0
    UNION ALL
    SELECT conv_id, turn, role, text, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) FROM faulty WHERE fault = 3
),
ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS nth,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again
    FROM turns
),
judged AS (
    SELECT *, bare = '' AS blank, bare <> '' AND again AS duplicate, bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS cut,
           coalesce(lag(role[1]) OVER (PARTITION BY conv_id ORDER BY nth) || role[1] NOT IN ('su', 'ua', 'au'), false) AS illegal
    FROM ordered
),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
           count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (cut) AS truncated, count(*) FILTER (illegal) AS illegal, count(*) AS n
    FROM judged GROUP BY conv_id
),
best(conv_id, nth, n, e, s, u, a) AS (
    SELECT conv_id, 0, n, {_BEST}::{_TYPE}, NULL::{_TYPE}, NULL::{_TYPE}, NULL::{_TYPE} FROM counts
    UNION ALL
    SELECT conv_id, nth, n, {_read()}
    FROM ({_inserted("SELECT b.conv_id, j.nth, b.n, b.e, b.s, b.u, b.a, role, text, blank OR duplicate AS must_go, cut::BIGINT AS broken FROM best b JOIN judged j ON b.conv_id IS NOT DISTINCT FROM j.conv_id AND j.nth = b.nth + 1")})
),
ended AS (SELECT conv_id, list_min([e, a]) AS way FROM ({_inserted("SELECT * FROM best WHERE nth = n")}))
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(way['c'], 0) AS cost, coalesce(way['k'], '') AS audit, sha256(coalesce(way['o'], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts k ON c.conv_id IS NOT DISTINCT FROM k.conv_id LEFT JOIN ended e ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""
