"""The registered queries of this package that SQL can express, for DuckDB."""

from __future__ import annotations

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source
), filled AS (
  SELECT *,
         coalesce(sum(source_size * 3) OVER before, 0) AS full_before,
         sum(source_size) OVER () AS total,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
  FROM sources
  WINDOW before AS (
    ORDER BY source_size * 3.0 / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
  )
), marked AS (
  SELECT *, source_size * 3 < (total - full_before)::DOUBLE / weight_left * weight AS is_full FROM filled
), open AS (
  SELECT (any_value(total) - coalesce(sum(source_size * 3) FILTER (is_full), 0))::DOUBLE
         / sum(weight) FILTER (NOT is_full) AS per_weight
  FROM marked
), targets AS (
  SELECT source, source_size,
         CASE WHEN is_full THEN (source_size * 3)::DOUBLE ELSE per_weight * weight END AS target
  FROM marked, open
), rated AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN least(target / source_size, 3.0) ELSE 0.0 END::DOUBLE AS rate,
         ('0x' || substr(sha256('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (floor(rate) + (draw < rate - floor(rate))::INT))::BIGINT AS taken
FROM rated
"""

EXACT_DEDUP = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM (SELECT doc_id, sha256({_LOWER.format("text")}) AS text_sha256 FROM documents)
WINDOW same AS (PARTITION BY text_sha256)
"""

NEAR_DEDUP = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("text")}, '{_WORD}') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
  END AS shingles FROM words
), sizes AS (
  SELECT doc_id, len(shingles)::BIGINT AS n_shingles FROM sets
), flat AS (
  SELECT doc_id, unnest(shingles) AS shingle FROM sets
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter
  FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * inter >= 85 * (x.n_shingles + y.n_shingles - inter)
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT doc_id, n_shingles, min(b) AS component_id, doc_id = min(b) AS kept
FROM sizes JOIN reached ON a = doc_id GROUP BY doc_id, n_shingles
"""

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT *, {_LOWER.format(f"trim(line, {_BLANKS})")} AS key FROM lines
), often AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT doc_id, line, place, last_doc IS NOT NULL AND last_doc <> doc_id AS gone
  FROM keyed LEFT JOIN often USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    step = "lambda x, i: xor(x >> 1, 3988292384 * (x & 1))"
    byte = f"lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), {step})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), {byte}), 4294967295)"


PREFIX_TRIE = f"""
WITH told AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place,
         {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, count(*) AS n, {crc32("conv_id::VARCHAR")} % 9 AS h FROM told GROUP BY conv_id
), taken AS (
  SELECT c.conv_id, 0 AS side, place, t
  FROM convs c JOIN told l ON l.conv_id = c.conv_id - c.conv_id % 5 AND place <= h
  UNION ALL
  SELECT c.conv_id, 1, place, t FROM convs c JOIN told l ON l.conv_id = c.conv_id AND place > h
), rebuilt AS (
  SELECT conv_id, coalesce(list(t ORDER BY side, place) FILTER (t IS NOT NULL), []) AS turns
  FROM convs LEFT JOIN taken USING (conv_id) GROUP BY conv_id
), beginnings AS (
  SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt
), nodes AS (
  SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '') AS ends,
         CASE WHEN depth > 0 THEN strlen(any_value(turns[depth].text)) ELSE 0 END AS bytes
  FROM beginnings GROUP BY path, depth
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id,
         (SELECT count(*) FROM nodes k WHERE k.depth = n.depth + 1 AND k.path[1:n.depth] = n.path) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
), subtrees AS (
  SELECT path[1:up] AS path, up AS depth, count(*) FILTER (n_children = 0) AS n_leaves,
         sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM linked) GROUP BY 1, 2
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ends) AS ends_sha256
FROM linked JOIN subtrees USING (path, depth)
"""

def _then(state: int, cost: str, edit: str, line: str | None) -> str:
    """The best way on from ``v{state}`` with one more edit before it."""
    v = f"v{state}"
    lines = f"list_prepend({line}, {v}.lines)" if line else f"{v}.lines"
    return f"{{'cost': {v}.cost + {cost}, 'audit': '{edit}' || {v}.audit, 'lines': {lines}}}"


def _edited(state: int, to: dict[str, int]) -> str:
    """Best edit of row r from a state; ``to``: states that roles lead to from it."""
    ways = [_then(state, "4", "D", None)]
    for letter, after in to.items():
        role = {"u": "user", "a": "assistant"}.get(letter)
        kept = _then(after, "3 * r.unended::INT", "K", "r.role || ':' || r.text")
        ways.append(f"CASE WHEN r.initial = '{letter}' AND NOT r.doomed THEN {kept} END")
        if role:
            other = _then(after, "3 + 3 * r.unended::INT", "R", f"'{role}:' || r.text")
            ways.append(f"CASE WHEN NOT r.doomed THEN {other} END")
    return f"list_min([{', '.join(ways)}])"


def _inserted(source: str) -> str:
    """``source`` with v0..v3 after an insertion or none, twice over: a third role put
    in at one place leads where one alone does."""
    for _ in range(2):
        best = ", ".join(
            f"list_min([v{s}, {_then(after, '3', 'I', repr(role + ':'))}]) AS v{s}"
            for s, after, role in ((0, 2, "user"), (1, 2, "user"), (2, 3, "assistant"), (3, 2, "user"))
        )
        source = f"SELECT * REPLACE ({best}) FROM ({source})"
    return source


_NOTHING = "{'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}"
_NEVER = "{'cost': 1000000000::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}"
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
_EDITS = ", ".join(f"{_edited(s, to)} AS v{s}" for s, to in enumerate(_NEXT))

TURN_REPAIR = f"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS h
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(0, CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM given
), judged AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial,
         row_number() OVER inside AS place, coalesce(lag(left(role, 1)) OVER inside || left(role, 1), 'su') AS pair,
         rtrim(text, {_BLANKS}) = '' AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         right(rtrim(text, {_BLANKS}), 1) NOT IN ('.', '!', '?') AS open_end
  FROM damaged WINDOW inside AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)
), rows_in AS (
  SELECT *, blank OR again AS doomed, open_end AND NOT again AND NOT blank AS unended FROM judged
), counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
         count(*) FILTER (unended) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM rows_in GROUP BY conv_id
), ways AS (
  {_inserted(f"SELECT conv_id, n AS place, {_NOTHING} AS v0, {_NEVER} AS v1, {_NEVER} AS v2, {_NOTHING} AS v3 FROM counted")}
  UNION ALL
  {_inserted(f"SELECT r.conv_id, r.place - 1 AS place, {_EDITS} FROM ways w JOIN rows_in r ON w.place = r.place AND w.conv_id IS NOT DISTINCT FROM r.conv_id")}
)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(v0.cost, 0) AS cost,
       coalesce(v0.audit, '') AS audit, sha256(coalesce(array_to_string(v0.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN ways w ON w.conv_id IS NOT DISTINCT FROM i.conv_id AND w.place = 0
"""  # noqa: E501

ORACLE = {
    "op2_mixing": MIXING,
    "op3_exact_dedup": EXACT_DEDUP,
    "op4_near_dedup": NEAR_DEDUP,
    "op8_line_dedup": LINE_DEDUP,
    "op11_prefix_trie": PREFIX_TRIE,
    "op13_turn_repair": TURN_REPAIR,
}
