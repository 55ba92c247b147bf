"""DuckDB SQL with the same result as the queries that SQL can express."""

from __future__ import annotations

from seedloom.llm import chat, secret_scan

ORACLES: dict[str, str] = {}


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _chat() -> str:
    template = chat.TEMPLATE
    said = text("</s>[INST] ok [/INST]")
    controls = " + ".join(
        f"(length(t) - length(replace(t, {text(c)}, ''))) // {len(c)}" for c in ["\\", *template.control_strings()]
    )
    marks = " ".join(f"WHEN {text(m.role)} THEN {len(m.opens) + len(m.closes)}" for m in template.marks)
    codes = "CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END"
    return f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
    UNION ALL SELECT -7, 0, 'user', {said} UNION ALL SELECT -7, 1, 'assistant', {said}
), grouped AS (
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
           coalesce(sum(length(t)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(t, '' ORDER BY turn, t) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(length(t) + {controls} + CASE role {marks} ELSE
               {len(template.other.opens) + len(template.other.closes) + len(template.between)} + length(role) END)::BIGINT
               AS formatted_chars,
           string_agg({codes}, '' ORDER BY turn, role, t) AS walk
    FROM turns GROUP BY conv_id
), good AS (SELECT *, length(regexp_extract(walk, '^s?(ua)*u?')) AS legal FROM grouped)
SELECT conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
       regexp_full_match(walk, 's?(ua)+') AS valid,
       CASE WHEN NOT regexp_full_match(walk, 's?(ua)+') THEN legal::INT END AS bad_turn
FROM good"""


ORACLES["op4_chat"] = _chat()


def _secrets() -> str:
    scan, window = secret_scan, secret_scan.WINDOW
    terms = "[" + ", ".join(map(str, scan._terms(window))) + "]"
    limits = [scan._sum_limit(bits, window) for bits in (scan.HEX_BITS, scan.MIXED_BITS)]
    assign = text(scan.ASSIGN.replace("(?i:(", "(?:((?i:").replace("api_?key))", "api_?key)))"))

    def places(source: str, pattern: str, columns: str, found: str) -> str:
        """Places of matches: lengths of gaps and matches added up."""
        return f"""
    SELECT {columns}, k, found, start, start + length(whole) AS stop FROM (
        SELECT {columns}, k, whole, found,
               sum(length(gap) + coalesce(length(whole), 0)) OVER (PARTITION BY {columns} ORDER BY k) - coalesce(length(whole), 0) AS start
        FROM (SELECT {columns}, unnest(range(len(gaps))) AS k, unnest(gaps) AS gap,
                     unnest(list_concat(wholes, [NULL])) AS whole, unnest(list_concat(founds, [NULL])) AS found
              FROM (SELECT {columns}, string_split_regex(t, {pattern}) AS gaps,
                           regexp_extract_all(t, {pattern}) AS wholes,
                           regexp_extract_all(t, {pattern}, {found}) AS founds
                    FROM {source} WHERE regexp_matches(t, {pattern})))
    ) WHERE whole IS NOT NULL"""

    kinds = [("assign", assign, 2), ("access", text(scan.PATTERNS["access"]), 0), ("hex", text(scan.PATTERNS["hex"]), 0)]
    base = " UNION ALL ".join(
        f"SELECT r, '{kind}' AS kind, {rank} AS rank, start, stop FROM ({places('docs', pattern, 'r', found)})"
        + (f" WHERE length(found) >= {scan.ASSIGN_LEAST}" if kind == "assign" else "")
        for rank, (kind, pattern, found) in enumerate(kinds)
    )
    allowed = " OR ".join(
        f"regexp_matches(found, {text(part)})"
        for part in scan.ALLOWED.replace("|(.)\\1{7,}", "").replace("|(?i:", "\0(?i:").replace("$|", "$\0").split("\0")
    )
    repeats = " OR ".join(f"contains(found, repeat({text(c)}, 8))" for c in scan.ALPHABET)
    return f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
base AS MATERIALIZED ({base}),
candidates AS MATERIALIZED (
    SELECT r, k, start, found, CASE WHEN regexp_full_match(found, '[0-9A-Fa-f]+') THEN {limits[0]} ELSE {limits[1]} END AS most
    FROM ({places('docs', text(scan.CANDIDATE), 'r', 0)}) WHERE NOT ({allowed} OR {repeats})
), windows AS (
    SELECT r, k, start, most, o, substr(found, o + 1, {window}) AS w
    FROM (SELECT *, unnest(range(length(found) - {window} + 1)) AS o FROM candidates)
), rich AS (
    SELECT r, k, start + o AS a FROM windows
    WHERE list_sum(list_transform(list_distinct(string_split(w, '')),
                   lambda c: ({terms})[{window} - length(replace(w, c, '')) + 1])) <= most
), united AS (
    SELECT r, k, min(a) AS start, max(a) + {window} AS stop FROM (
        SELECT r, k, a, sum(fresh) OVER (PARTITION BY r, k ORDER BY a) AS island FROM (
            SELECT r, k, a, CASE WHEN a - lag(a) OVER (PARTITION BY r, k ORDER BY a) <= {window} THEN 0 ELSE 1 END AS fresh FROM rich))
    GROUP BY r, k, island
), spans AS (
    SELECT r, kind, rank, start, stop FROM base
    UNION ALL
    SELECT r, 'entropy', 3, start, stop FROM united u
    WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.r = u.r AND b.start < u.stop AND u.start < b.stop)
), shown AS (
    SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, rank, stop) FILTER (kind <> 'entropy') AS base,
           string_agg(concat_ws(':', kind, start, stop), ',' ORDER BY start, rank, stop) AS spans
    FROM spans GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN shown USING (r)"""


ORACLES["op10_secret_scan"] = _secrets()


def _cheapest(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _edit(state: str, cost: str, initial: str, line: str = "''") -> str:
    """SQL of a state after one more edit; null stays null."""
    return (
        f"CASE WHEN {state} IS NOT NULL THEN {{'cost': {state}.cost + {cost}, 'audit': {state}.audit || '{initial}', "
        f"'out': {state}.out || {line}}} END"
    )


#: States: 0 nothing yet, 1 after a system turn, 2 after a user, 3 after an assistant; each the least
#: (cost, audit, repaired lines). An inserted turn comes before the next row or at the end.
ORACLES["op11_conversation_repair"] = rf"""
WITH RECURSIVE named AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
    FROM conversations
),
coded AS (
    SELECT *, xor(list_reduce(list_transform(string_split(name, ''), lambda x: ord(x)::BIGINT), lambda sum, byte:
        list_reduce(list_transform(range(8), lambda i: i::BIGINT), lambda c, i:
            CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, xor(sum, byte)), 4294967295::BIGINT),
        4294967295::BIGINT) % 20 AS fault
    FROM named
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM coded, range(CASE WHEN fault = 3 THEN 2 ELSE 1 END) WHERE fault <> 0
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
        NOT regexp_matches(text, '[^ 	-]') AS is_blank,
        NOT regexp_matches(text, '[.!?][ 	-]*\z') AS is_open
    FROM damaged
),
judged AS (
    SELECT conv_id, turn, role, text, place, left(role, 1) AS initial, is_blank,
        NOT is_blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS is_copy, is_open,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before
    FROM placed
),
facts AS (
    SELECT conv_id, count(*) AS n,
        coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_copy) AS duplicate,
        count(*) FILTER (is_open AND NOT is_blank AND NOT is_copy) AS truncated,
        count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY conv_id
),
steps AS (
    SELECT conv_id, 0 AS place, {{'cost': 0, 'audit': '', 'out': ''}} AS s0,
        CASE WHEN false THEN {{'cost': 0, 'audit': '', 'out': ''}} END AS s1,
        CASE WHEN false THEN {{'cost': 0, 'audit': '', 'out': ''}} END AS s2,
        CASE WHEN false THEN {{'cost': 0, 'audit': '', 'out': ''}} END AS s3
    FROM facts
    UNION ALL
    SELECT conv_id, place, {_edit("s0", "4", "D")},
        {_cheapest(_edit("s1", "4", "D"), f"CASE WHEN stays AND initial = 's' THEN {_edit('s0', 'extra', 'K', 'line')} END")},
        {_cheapest(
            _edit("r2", "4", "D"),
            *[f"CASE WHEN stays AND initial = 'u' THEN {_edit(s, 'extra', 'K', 'line')} END" for s in ("s0", "s1", "r3")],
            *[f"CASE WHEN stays THEN {_edit(s, 'extra + 3', 'R', 'as_user')} END" for s in ("s0", "s1", "r3")],
        )},
        {_cheapest(
            _edit("r3", "4", "D"),
            f"CASE WHEN stays AND initial = 'a' THEN {_edit('r2', 'extra', 'K', 'line')} END",
            f"CASE WHEN stays THEN {_edit('r2', 'extra + 3', 'R', 'as_assistant')} END",
        )}
    FROM (
        SELECT *, {_cheapest("s3", _edit("r2", "3", "I", "chr(10) || 'assistant:'"))} AS r3
        FROM (
            SELECT j.conv_id, j.place, j.initial, NOT (is_blank OR is_copy) AS stays,
                CASE WHEN is_open THEN 3 ELSE 0 END AS extra, chr(10) || role || ':' || text AS line,
                chr(10) || 'user:' || text AS as_user, chr(10) || 'assistant:' || text AS as_assistant, s0, s1, s3,
                {_cheapest("s2", *[_edit(s, "3", "I", "chr(10) || 'user:'") for s in ("s0", "s1", "s3")])} AS r2
            FROM steps s JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.place = s.place + 1
        )
    )
),
ended AS (
    SELECT s.conv_id, s0, s3, {_cheapest("s2", *[_edit(s, "3", "I", "chr(10) || 'user:'") for s in ("s0", "s1", "s3")])} AS r2
    FROM steps s JOIN facts f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND s.place = f.n
),
best AS (
    SELECT conv_id, {_cheapest("s0", "s3", _edit("r2", "3", "I", "chr(10) || 'assistant:'"))} AS b FROM ended
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.cost, 0)::BIGINT AS cost,
    coalesce(b.audit, '') AS audit, sha256(coalesce(b.out[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN facts f ON o.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN best ON o.conv_id IS NOT DISTINCT FROM best.conv_id
"""
