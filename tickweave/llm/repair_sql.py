"""DuckDB SQL of the conversation repair: a recursion over rows from the last to the first, with the least (cost, audit) by state."""

from __future__ import annotations

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _after(option: str, cost: str, edit: str) -> str:
    return f"struct_pack(c := {option}.c + {cost}, a := '{edit}' || {option}.a)"


_NEVER = "struct_pack(c := 1000000000::bigint, a := '')"
#: Where an edit may lead: least suffix after the row by state (z0 .. z3), from each state.
_USER, _ASSISTANT = "z2", "z3"


def _row(state: int) -> str:
    """Least (cost, audit) from a state before a row, without inserts before it."""
    delete = _after(f"z{state}", "2", "D")
    to = _ASSISTANT if state == 2 else _USER
    keeps = [(to, "a" if state == 2 else "u")] + ([("z1", "s")] if state == 0 else [])
    kept = [f"CASE WHEN NOT must AND initial = '{initial}' THEN {_after(target, 'late', 'K')} ELSE {_NEVER} END" for target, initial in keeps]
    rerole = f"CASE WHEN NOT must THEN {_after(to, '1 + late', 'R')} ELSE {_NEVER} END"
    return _least(delete, *kept, rerole)


#: Inserts before a row, or at the end: none, one or two (more never pay).
_INSERTED = """
SELECT {keys},
       list_min([y0, struct_pack(c := y2.c + 5, a := 'I' || y2.a), struct_pack(c := y3.c + 10, a := 'II' || y3.a)]) AS z0,
       list_min([y1, struct_pack(c := y2.c + 5, a := 'I' || y2.a), struct_pack(c := y3.c + 10, a := 'II' || y3.a)]) AS z1,
       list_min([y2, struct_pack(c := y3.c + 5, a := 'I' || y3.a)]) AS z2,
       list_min([y3, struct_pack(c := y2.c + 5, a := 'I' || y2.a)]) AS z3
FROM ({source})"""

SQL = f"""
WITH RECURSIVE crc_table AS (
    SELECT list(v ORDER BY i) AS entries FROM (
        SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
        FROM (SELECT range::bigint AS i FROM range(256)))
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, fault,
           unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               xor(list_reduce(list_concat([4294967295::bigint], [ascii(c)::bigint FOR c IN string_split(
                       coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), '')]),
                   lambda c, b: xor(c // 256, entries[xor(c % 256, b) + 1])), 4294967295) % 20 AS fault
        FROM conversations, crc_table)
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) AS nth
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
                 left(role, 1) AS initial, rtrim(text, {_SPACE}) AS body
          FROM damaged WHERE fault <> 0)
), marked AS (
    SELECT *, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS kind,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS steps
    FROM placed
), counts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (WHERE kind = 'blank') AS blank, count(*) FILTER (WHERE kind = 'duplicate') AS duplicate,
           count(*) FILTER (WHERE kind = 'truncated') AS truncated,
           count(*) FILTER (WHERE steps NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
), best AS (
    {_INSERTED.format(keys='conv_id, left_over', source=f"""
        SELECT conv_id, n AS left_over, struct_pack(c := 0::bigint, a := '') AS y0, {_NEVER} AS y1, {_NEVER} AS y2,
               struct_pack(c := 0::bigint, a := '') AS y3 FROM counts""")}
    UNION ALL
    {_INSERTED.format(keys='conv_id, left_over', source=f"""
        SELECT conv_id, left_over - 1 AS left_over, {', '.join(f'{_row(k)} AS y{k}' for k in range(4))}
        FROM (SELECT b.*, m.initial, m.kind IN ('blank', 'duplicate') AS must, CASE WHEN m.kind = 'truncated' THEN 5 ELSE 0 END AS late
              FROM best b JOIN marked m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.place = b.left_over)""")}
), audits AS (
    SELECT conv_id, z0.c AS cost, z0.a AS audit FROM best WHERE left_over = 0
), edits AS (
    SELECT conv_id, pos, substr(audit, pos, 1) AS edit, (length(audit) - length(replace(audit, 'D', ''))) AS gone, length(audit) AS total,
           length(replace(substr(audit, 1, pos), 'I', '')) AS place, length(replace(substr(audit, 1, pos - 1), 'D', '')) AS line
    FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS pos FROM audits)
), texts AS (
    SELECT e.conv_id, string_agg(CASE WHEN edit = 'K' THEN m.role
                                      WHEN (line - (total - gone) % 2) % 2 = 0 THEN 'user' ELSE 'assistant' END
                                 || ':' || CASE WHEN edit = 'I' THEN '' ELSE m.text END, chr(10) ORDER BY pos) AS whole
    FROM edits e LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM e.conv_id AND m.place = e.place AND e.edit <> 'I'
    WHERE edit <> 'D' GROUP BY e.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN texts t ON t.conv_id IS NOT DISTINCT FROM o.conv_id
"""
