"""DuckDB SQL with the same result as each query in ``workload.queries``."""

from __future__ import annotations

import re

from seedloom.functions.shingles import ALPHABET, PRIME, WORD, coefficients
from seedloom.functions.text import WHITESPACE
from seedloom.operators import prompts, quota
from workload import inputs as data

ORACLES: dict[str, str] = {}

_WS = " || ".join(f"chr({ord(ch)})" for ch in WHITESPACE)


def strip(expr: str) -> str:
    return f"trim({expr}, {_WS})"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def strings(values) -> str:
    return "[" + ", ".join(text(value) for value in values) + "]"


def fill(template: str, **slots: str) -> str:
    pieces = re.split(r"<<(\w+)>>", template)
    return " || ".join(slots[p] if i % 2 else text(p) for i, p in enumerate(pieces) if i % 2 or p)


def key(*parts: str) -> str:
    return "md5(concat_ws(':', " + ", ".join(parts) + "))"


def word(hex_expr: str, place: int) -> str:
    return f"CAST('0x' || substr({hex_expr}, {1 + 8 * place}, 8) AS BIGINT)"


SEED = f"'{data.SEED}'"
ROW_KEY = f"{key(SEED, 'doc_id')} || ':' || CAST(doc_id AS VARCHAR)"

# --- intake -------------------------------------------------------------------------

_CHECKED = f"""
raw AS (
  SELECT doc_id AS row_idx, source, doc_id % 23 <> 7 AS is_object,
         {strip('(' + data.RAW_TEXT + ')')} AS text, {strip('(' + data.RAW_LABEL + ')')} AS label
  FROM documents),
checked AS (
  SELECT *, CASE WHEN NOT is_object THEN 'not_object' WHEN coalesce(text, '') = '' THEN 'missing_text'
                 WHEN coalesce(label, '') = '' THEN 'missing_label' END AS reject_reason
  FROM raw),
valid AS (SELECT * FROM checked WHERE reject_reason IS NULL)
"""

ORACLES["intake_mapped"] = f"""
WITH {_CHECKED}
SELECT row_idx, 'document_content' AS text_key, 'doc_class' AS label_key, text, label FROM valid
"""
ORACLES["intake_valid"] = f"WITH {_CHECKED} SELECT row_idx, text, label, source AS extra_source FROM valid"
ORACLES["intake_quarantine"] = f"""
WITH {_CHECKED} SELECT row_idx, reject_reason FROM checked WHERE reject_reason IS NOT NULL
"""
ORACLES["intake_metadata"] = f"""
WITH {_CHECKED}, per_label AS (SELECT label, count(*) AS n FROM valid GROUP BY label)
SELECT (SELECT count(*) FROM checked) AS total_raw_rows,
       (SELECT count(*) FROM valid) AS total_valid_rows,
       (SELECT count(*) FROM checked WHERE reject_reason IS NOT NULL) AS total_dropped_rows,
       string_agg(label, '|' ORDER BY label) AS unique_labels,
       string_agg(label || '=' || n, '|' ORDER BY label) AS label_distribution
FROM per_label
"""
ORACLES["event_rows_unmapped"] = """
SELECT 'missing_text' AS reject_reason, count(*) AS n,
       CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k
FROM events
"""

_ROLES = """
seed AS (SELECT doc_id, text, lang AS label FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)),
synthetic AS (SELECT doc_id, text, lang AS label FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))
"""

ORACLES["label_distribution"] = f"WITH {_ROLES} SELECT label, count(*) AS n FROM seed GROUP BY label"
ORACLES["json_array_round_trip"] = """
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS row_idx, text, source AS label, CAST(doc_id AS VARCHAR) AS doc_id FROM documents
"""
ORACLES["trials_csv_round_trip"] = """
SELECT 'run 1' AS run_id, CAST(o_orderkey AS VARCHAR) AS number, o_orderpriority AS note, round(CAST(o_totalprice AS DOUBLE), 2) AS value
FROM orders
"""
ORACLES["predictions_round_trip"] = """
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS line, CASE WHEN doc_id % 7 <> 3 THEN 2 END AS turns,
       CASE WHEN doc_id % 7 <> 3 THEN source END AS reply, CASE WHEN doc_id % 7 = 3 THEN 'malformed' END AS defect
FROM documents
"""
ORACLES["report_labels"] = "SELECT source AS label, count(*) AS n_rows FROM documents WHERE source IS NOT NULL GROUP BY source"
ORACLES["detected_labels"] = "SELECT string_agg(DISTINCT source, '|' ORDER BY source) AS labels FROM documents"
ORACLES["label_conflicts"] = """
SELECT sha256(text) AS text_digest, count(DISTINCT source) AS n_labels, min(doc_id) AS first_row_idx, count(*) AS n_rows
FROM documents GROUP BY text HAVING count(DISTINCT source) > 1
"""
ORACLES["intake_gate"] = f"""
WITH {_CHECKED}, facts AS (
  SELECT (SELECT count(DISTINCT label) FROM valid) AS n_labels,
         (SELECT count(*) FROM checked WHERE reject_reason IS NOT NULL) AS n_rejected,
         (SELECT count(*) FROM (SELECT text FROM valid GROUP BY text HAVING count(DISTINCT label) > 1)) AS n_conflicts)
SELECT n_labels, n_rejected, n_conflicts, n_labels >= 2 AS enough_labels, n_rejected = 0 AS all_rows_complete,
       true AS unknown_ratio_ok, n_labels >= 2 AND n_rejected = 0 AND n_conflicts = 0 AS passed
FROM facts
"""

# --- sources and sinks --------------------------------------------------------------

ORACLES["jsonl_round_trip"] = f"""
WITH {_ROLES} SELECT doc_id, {strip('text')} AS text, label FROM seed WHERE {strip('text')} <> ''
"""
ORACLES["csv_round_trip"] = ORACLES["jsonl_round_trip"]

# --- generation planning ------------------------------------------------------------

_PLAN = f"""
{_ROLES},
sizes AS (SELECT CAST(ceil(CAST(500 AS DOUBLE) * CAST(0.10 AS DOUBLE)) AS BIGINT) AS for_unknown,
                 (SELECT count(DISTINCT label) FROM seed) AS k),
plan AS (
  SELECT DISTINCT label, CAST(ceil(CAST(500 - for_unknown AS DOUBLE) / k) AS BIGINT) AS target FROM seed, sizes
  UNION ALL SELECT 'unknown', for_unknown FROM sizes),
collected AS (SELECT label, CAST(floor(count(*) / 5.0) AS BIGINT) AS collected FROM synthetic GROUP BY label),
short AS (
  SELECT label, target, target - coalesce(collected, 0) AS need FROM plan LEFT JOIN collected USING (label)),
need AS (
  SELECT label, target, need, greatest(1, CAST(ceil(CAST(need AS DOUBLE) / 4 * 1.5) AS BIGINT)) AS n_prompts
  FROM short WHERE need > 0)
"""
ORACLES["quota_plan"] = f"WITH {_PLAN} SELECT label, target FROM plan"
ORACLES["quota_need"] = f"WITH {_PLAN} SELECT label, target, need, n_prompts FROM need"

_EXAMPLES = f"""
examples AS (
  SELECT label, row_number() OVER (PARTITION BY label ORDER BY {ROW_KEY}) - 1 AS example_idx,
         doc_id AS example_id, text
  FROM seed)
"""
ORACLES["examples_by_label"] = f"WITH {_ROLES}, {_EXAMPLES} SELECT label, example_idx, example_id FROM examples"


def _request_key(purpose: str) -> str:
    return key(SEED, "'1'", "request_id", f"'{purpose}'")


_REQUESTS = f"""
{_PLAN}, {_EXAMPLES},
offsets AS (
  SELECT *, coalesce(sum(n_prompts) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base
  FROM need),
slots AS (SELECT CAST(base + step AS BIGINT) AS request_id, label FROM offsets, range(n_prompts) AS r(step)),
n_examples AS (SELECT label, count(*) AS n FROM examples GROUP BY label),
words AS (
  SELECT request_id, label, n, {word('k', 0)} % n AS a, {word('k', 1)} % greatest(n - 1, 1) AS b0,
         {word('k', 2)} % greatest(n - 2, 1) AS c0
  FROM (SELECT *, {_request_key('examples')} AS k FROM slots JOIN n_examples USING (label))),
second AS (SELECT *, b0 + CASE WHEN b0 >= a THEN 1 ELSE 0 END AS b FROM words),
third0 AS (SELECT *, c0 + CASE WHEN c0 >= least(a, b) THEN 1 ELSE 0 END AS c1 FROM second),
third AS (SELECT *, c1 + CASE WHEN c1 >= greatest(a, b) THEN 1 ELSE 0 END AS c FROM third0),
picks AS (
  SELECT request_id, label, 1 AS pick, a AS example_idx FROM third
  UNION ALL SELECT request_id, label, 2, b FROM third WHERE n >= 2
  UNION ALL SELECT request_id, label, 3, c FROM third WHERE n >= 3),
picked AS (
  SELECT request_id, string_agg(CAST(example_id AS VARCHAR), '|' ORDER BY pick) AS example_ids,
         string_agg(chr(10) || '- ' || text || chr(10), '' ORDER BY pick) AS listed
  FROM picks JOIN examples USING (label, example_idx) GROUP BY request_id),
requests AS (
  SELECT request_id, label, coalesce(example_ids, '') AS example_ids, listed,
         {strings(quota.DIFFICULTIES)}[1 + {word(_request_key('style'), 1)} % 4] AS difficulty,
         CASE WHEN label = 'unknown'
              THEN {strings(quota.FALLBACK_UNKNOWN_RULES)}[1 + {word(_request_key('style'), 0)} % 2]
              ELSE {strings(quota.FALLBACK_RULES)}[1 + {word(_request_key('style'), 0)} % 3] END AS diversity_rule,
         {_request_key('shuffle')} AS shuffle_key
  FROM slots LEFT JOIN picked USING (request_id))
"""
ORACLES["fewshot_requests"] = f"""
WITH {_REQUESTS} SELECT request_id, label, example_ids, difficulty, diversity_rule, shuffle_key FROM requests
"""
ORACLES["generation_prompts"] = f"""
WITH {_REQUESTS}
SELECT request_id, {text(prompts.GENERATOR_SYSTEM)} AS system_prompt,
       {fill(prompts.GENERATOR_USER, task_description=text(data.TASK), label='label', diversity_rule='diversity_rule',
             difficulty='difficulty',
             example_block=f"CASE WHEN listed IS NOT NULL THEN chr(10) || listed || chr(10) ELSE {fill(prompts.NO_EXAMPLES, label='label')} END")}
       AS user_prompt
FROM requests
"""
ORACLES["rule_prompt"] = f"""
WITH {_ROLES}, names AS (SELECT string_agg(DISTINCT label, ', ' ORDER BY label) || ', unknown' AS names FROM seed)
SELECT {text(prompts.RULES_SYSTEM)} AS system_prompt,
       {fill(prompts.RULES_USER, task_description=text(data.TASK), label_names='names')} AS user_prompt
FROM names
"""


def without_fence(expr: str) -> str:
    return (
        f"CASE WHEN starts_with({expr}, '```') THEN "
        f"regexp_replace(regexp_replace({expr}, '^```(?:json)?\\s*', ''), '\\s*```$', '') ELSE {expr} END"
    )


ORACLES["rules_parsed"] = f"""
WITH body AS (SELECT doc_id, {without_fence(strip('(' + data.RULES_REPLY + ')'))} AS body FROM documents),
safe AS (SELECT doc_id, CASE WHEN json_valid(body) THEN body ELSE '{{}}' END AS j FROM body),
lists AS (
  SELECT doc_id, json_type(j, '$.diversity_rules') = 'ARRAY' AND json_type(j, '$.unknown_diversity_rules') = 'ARRAY' AS good,
         json_extract_string(j, '$.diversity_rules[*]') AS rules,
         json_extract_string(j, '$.unknown_diversity_rules[*]') AS unknown_rules
  FROM safe)
SELECT doc_id, CASE WHEN good THEN 'json' ELSE 'fallback' END AS rules_status,
       array_to_string(CASE WHEN good THEN rules ELSE {strings(quota.FALLBACK_RULES)} END, '|') AS diversity_rules,
       array_to_string(CASE WHEN good THEN unknown_rules ELSE {strings(quota.FALLBACK_UNKNOWN_RULES)} END, '|')
         AS unknown_diversity_rules
FROM lists
"""

# --- candidates ---------------------------------------------------------------------

ORACLES["candidate_explode"] = f"""
WITH replies AS (
  SELECT doc_id AS request_id, lang AS label, {data.batch_reply('CAST(to_json(text) AS VARCHAR)')} AS reply FROM documents),
thought AS (
  SELECT request_id, label,
         {strip("regexp_replace(regexp_replace(reply, '(?is)<think>.*?</think>', '', 'g'), '(?is)<reasoning>.*?</reasoning>', '', 'g')")} AS reply
  FROM replies),
clean AS (SELECT request_id, label, {without_fence('reply')} AS clean FROM thought),
sliced AS (SELECT *, regexp_extract(clean, '(?s)\\{{.*\\}}') AS slice FROM clean),
safe AS (SELECT *, CASE WHEN json_valid(slice) THEN slice ELSE '{{}}' END AS j FROM sliced),
typed AS (
  SELECT *, json_type(j, '$.results') = 'ARRAY'
            AND len(list_filter(json_type(j, '$.results[*]'), lambda x: x <> 'VARCHAR')) = 0 AS good FROM safe),
texts AS (
  SELECT request_id, label, coalesce(good, false) AS good,
         CASE WHEN good THEN list_filter(list_transform(json_extract_string(j, '$.results[*]'), lambda x: {strip('x')}), lambda x: x <> '')
              WHEN contains(clean, '{{') AND contains(clean, '}}')
              THEN list_filter(regexp_extract_all(clean, '"([^"]+)"', 1), lambda x: x <> 'results' AND length({strip('x')}) > 10)
              ELSE [] END AS texts
  FROM typed),
kept AS (
  SELECT request_id, label, CASE WHEN len(texts) = 0 THEN 'empty' WHEN good THEN 'json' ELSE 'quoted' END AS batch_status,
         CASE WHEN len(texts) = 0 THEN [''] ELSE texts END AS texts
  FROM texts)
SELECT request_id, label, batch_status, generate_subscripts(texts, 1) - 1 AS candidate_pos, unnest(texts) AS cleaned_text
FROM kept
"""

_VECTORS = f"""
candidates AS (
  SELECT vec_id AS seq, {data.VECTOR_LABEL} AS label, {data.VECTOR_TEXT} AS cleaned_text,
         {data.judge_reply('vec_id')} AS judge_raw_output, CAST(embedding AS DOUBLE[]) AS v
  FROM embeddings)
"""
_VALID_TEXT = f"{strip('cleaned_text')} <> '' AND lower(cleaned_text) <> 'none'"
ORACLES["candidate_valid"] = f"WITH {_VECTORS} SELECT seq, label, cleaned_text FROM candidates WHERE {_VALID_TEXT}"
ORACLES["judge_prompts"] = f"""
SELECT doc_id, {fill(prompts.JUDGE_USER, task_description=text(data.TASK), cleaned_text='text', label='lang')} AS judge_prompt
FROM documents
"""


def _judged(source: str, columns: str) -> str:
    """CTEs that read the judge reply ``judge_raw_output`` of ``source``."""
    return f"""
judge_safe AS (
  SELECT *, CASE WHEN json_valid(coalesce(judge_raw_output, '{{}}')) THEN coalesce(judge_raw_output, '{{}}') ELSE '{{}}' END AS j
  FROM {source}),
judge_read AS (
  SELECT *, TRY_CAST(json_extract_string(j, '$.fidelity') AS DOUBLE) AS f,
         TRY_CAST(json_extract_string(j, '$.naturalness') AS DOUBLE) AS n,
         TRY_CAST(json_extract_string(j, '$.utility') AS DOUBLE) AS u,
         coalesce(json_type(j, '$.reasoning') = 'VARCHAR', false) AS typed
  FROM judge_safe),
judge_ok AS (
  SELECT *, coalesce(typed AND f BETWEEN 0 AND 1 AND n BETWEEN 0 AND 1 AND u BETWEEN 0 AND 1, false) AS complete FROM judge_read),
judged AS (
  SELECT {columns}, CASE WHEN complete THEN f END AS fidelity, CASE WHEN complete THEN n END AS naturalness,
         CASE WHEN complete THEN u END AS utility,
         CASE WHEN complete THEN json_extract_string(j, '$.reasoning') END AS reasoning,
         CASE WHEN complete THEN f * CAST(0.4 AS DOUBLE) + n * CAST(0.3 AS DOUBLE) + u * CAST(0.3 AS DOUBLE) END AS overall_score
  FROM judge_ok),
scored AS (
  SELECT *, CASE WHEN overall_score IS NULL THEN 'judge_parse' WHEN overall_score < CAST(0.7 AS DOUBLE) THEN 'low_score'
                 ELSE 'ok' END AS judge_status
  FROM judged)
"""


def rounded(*names: str) -> str:
    return ", ".join(f"round({name}, 6) AS {name}" for name in names)


ORACLES["judge_scores"] = f"""
WITH replies AS (SELECT doc_id, {data.judge_reply('doc_id')} AS judge_raw_output FROM documents),
{_judged('replies', 'doc_id')}
SELECT doc_id, {rounded('fidelity', 'naturalness', 'utility', 'overall_score')}, reasoning, judge_status FROM scored
"""

# --- similarity ---------------------------------------------------------------------

ORACLES["exact_dup_guard"] = f"""
WITH RECURSIVE {_ROLES},
offered AS (
  SELECT doc_id AS seq, {data.GUARD_LABEL} AS label, text AS cleaned_text, {data.judge_reply('doc_id')} AS judge_raw_output
  FROM synthetic),
{_judged('offered', 'seq, label, cleaned_text, judge_raw_output')},
gated AS (SELECT *, NOT ({_VALID_TEXT}) OR judge_status <> 'ok' AS gate, cleaned_text IN (SELECT text FROM seed) AS of_seed FROM scored),
usable AS (
  SELECT seq, label, md5(cleaned_text) AS d, row_number() OVER (ORDER BY seq) AS i FROM gated WHERE NOT gate AND NOT of_seed),
steps AS (
  SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS texts, CAST([] AS BIGINT[]) AS taken, 0 AS few
  UNION ALL
  SELECT u.i, CASE WHEN {{ok}} THEN list_append(texts, d) ELSE texts END,
         CASE WHEN {{ok}} THEN list_append(taken, seq) ELSE taken END, few + CAST({{ok}} AND label = 'few' AS INTEGER)
  FROM steps s JOIN usable u ON u.i = s.i + 1),
final AS (SELECT unnest(taken) AS seq FROM steps WHERE i = (SELECT max(i) FROM steps)),
firsts AS (SELECT cleaned_text, min(seq) AS first FROM gated SEMI JOIN final USING (seq) GROUP BY cleaned_text),
cut AS (SELECT CASE WHEN count(*) >= {data.GUARD_FEW} THEN max(seq) END AS last FROM gated SEMI JOIN final USING (seq) WHERE label = 'few')
SELECT seq, NOT gate AND NOT coalesce(label = 'few' AND seq > last, false) AND (of_seed OR coalesce(seq > first, false)) AS is_copy
FROM gated LEFT JOIN firsts USING (cleaned_text), cut
""".replace("{ok}", f"(NOT list_contains(texts, d) AND (label <> 'few' OR few < {data.GUARD_FEW}))")

_CLEAN = "lower(regexp_replace(text, '[^a-zA-Z0-9ก-๙]', '', 'g'))"


def _shingles(source: str, name: str) -> str:
    """CTE of distinct 5-character shingles (a shorter text is one shingle)."""
    return f"""
{name} AS (
  SELECT DISTINCT doc_id, substr(clean, i, 5) AS g
  FROM (SELECT doc_id, {_CLEAN} AS clean FROM {source}), range(1, greatest(length(clean) - 3, 2)) AS r(i)
  WHERE clean <> '')"""


_A, _B = coefficients()
_CHAR_CODE = " ".join(
    f"WHEN unicode({{c}}) BETWEEN {first} AND {last} THEN unicode({{c}}) - {first} + {code}"
    for first, last, code in ((48, 57, 1), (97, 122, 11), (0x0E01, 0x0E59, 37))
)
assert len(ALPHABET) == 125


def _char_code(place: int) -> str:
    char = f"substr(g, {place}, 1)"
    return f"CASE WHEN length(g) < {place} THEN 0 {_CHAR_CODE.format(c=char)} END"


_PACKED = " + ".join(f"CAST({_char_code(place)} AS BIGINT) * {128 ** (5 - place)}" for place in range(1, 6))
ORACLES["minhash_signature_rows"] = f"""
WITH {_shingles('documents', 'sh')},
x1 AS (SELECT doc_id, CAST({_PACKED} AS BIGINT) % {PRIME} AS x FROM sh),
x4 AS (SELECT doc_id, x, (x * x % {PRIME}) * (x * x % {PRIME}) % {PRIME} AS q FROM x1),
mixed AS (SELECT doc_id, q * x % {PRIME} AS x FROM x4),
signed AS (
  SELECT doc_id, {', '.join(f'min(({a} * x + {b}) % {WORD}) AS h{i}' for i, (a, b) in enumerate(zip(_A, _B)))}
  FROM mixed GROUP BY doc_id)
SELECT doc_id, concat_ws('|', {', '.join(f'h{i}' for i in range(len(_A)))}) AS signature
FROM documents LEFT JOIN signed USING (doc_id)
"""


def _near_pairs(left: str, right: str, condition: str, tenths: int = 9) -> str:
    """CTEs up to ``flagged``: rows of ``left`` with the smallest row of ``right`` at Jaccard >= tenths / 10."""
    return f"""
sizes_l AS (SELECT doc_id, count(*) AS n FROM {left} GROUP BY doc_id),
sizes_r AS (SELECT doc_id, count(*) AS n FROM {right} GROUP BY doc_id),
frequency AS (SELECT g, count(*) AS df FROM (SELECT g FROM {left} UNION ALL SELECT g FROM {right}) GROUP BY g),
ranked_l AS (
  SELECT s.doc_id, g, n, row_number() OVER (PARTITION BY s.doc_id ORDER BY df, g) AS rank
  FROM {left} s JOIN frequency USING (g) JOIN sizes_l USING (doc_id)),
ranked_r AS (
  SELECT s.doc_id, g, n, row_number() OVER (PARTITION BY s.doc_id ORDER BY df, g) AS rank
  FROM {right} s JOIN frequency USING (g) JOIN sizes_r USING (doc_id)),
prefix_l AS (SELECT * FROM ranked_l WHERE rank <= n - ceil(n * {tenths} / 10.0) + 1),
prefix_r AS (SELECT * FROM ranked_r WHERE rank <= n - ceil(n * {tenths} / 10.0) + 1),
pairs AS (
  SELECT DISTINCT l.doc_id AS a, r.doc_id AS b, l.n AS na, r.n AS nb
  FROM prefix_l l JOIN prefix_r r ON l.g = r.g AND {condition}
  WHERE 10 * least(l.n, r.n) >= {tenths} * greatest(l.n, r.n)),
shared AS (
  SELECT a, b, na, nb, count(*) AS common
  FROM pairs JOIN {left} s ON s.doc_id = a JOIN {right} t ON t.doc_id = b AND t.g = s.g GROUP BY a, b, na, nb),
flagged AS (
  SELECT a AS doc_id, min(b) AS dup_of, arg_min(common / CAST(na + nb - common AS DOUBLE), b) AS similarity
  FROM shared WHERE 10 * common >= {tenths} * (na + nb - common) GROUP BY a)
"""


def _near_status(source: str) -> str:
    return f"""
SELECT doc_id, CASE WHEN {_CLEAN} = '' THEN 'no_signal' WHEN doc_id IN (SELECT doc_id FROM flagged) THEN 'near_dup'
                    ELSE 'unique' END AS status, dup_of, round(similarity, 6) AS similarity
FROM {source} LEFT JOIN flagged USING (doc_id)
"""


for _name, _tenths in (("near_dup_flags", 9), ("near_dup_flags_70", 7)):
    ORACLES[_name] = f"""
WITH {_shingles('documents', 'sh')}, {_near_pairs('sh', 'sh', 'r.doc_id < l.doc_id', _tenths)} {_near_status('documents')}
"""
ORACLES["near_dup_of_seed"] = f"""
WITH {_ROLES}, {_shingles('synthetic', 'sh_l')}, {_shingles('seed', 'sh_r')},
{_near_pairs('sh_l', 'sh_r', 'true')} {_near_status('synthetic')}
"""

_THRESHOLD = f"CAST({data.SEMANTIC_THRESHOLD} AS DOUBLE)"
ORACLES["semantic_redundant"] = f"""
WITH v AS (SELECT vec_id AS seq, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
best AS (SELECT a.seq, max(list_inner_product(a.v, b.v)) AS m FROM v a JOIN v b ON b.seq < a.seq GROUP BY a.seq)
SELECT v.seq, round(m, 6) AS max_similarity, coalesce(m >= {_THRESHOLD}, false) AS is_redundant
FROM v LEFT JOIN best USING (seq)
"""

# --- acceptance ---------------------------------------------------------------------

_T = data.ACCEPT_TARGET
_GREEDY = f"""
{_VECTORS}, {_judged('candidates', 'seq, label, cleaned_text, judge_raw_output, v')},
gated AS (
  SELECT *, CASE WHEN NOT ({_VALID_TEXT}) THEN 'invalid_text' WHEN judge_status <> 'ok' THEN judge_status END AS gate
  FROM scored),
quota_sizes AS (
  SELECT CAST(ceil(CAST({_T} AS DOUBLE) * CAST(0.10 AS DOUBLE)) AS BIGINT) AS for_unknown,
         (SELECT count(DISTINCT label) FROM candidates WHERE label <> 'unknown') AS k),
quotas AS (
  SELECT DISTINCT label, CASE WHEN label = 'unknown' THEN for_unknown
                              ELSE CAST(ceil(CAST({_T} - for_unknown AS DOUBLE) / k) AS BIGINT) END AS quota
  FROM candidates, quota_sizes),
usable AS (
  SELECT seq, label, v, quota, row_number() OVER (ORDER BY seq) AS i
  FROM gated JOIN quotas USING (label) WHERE gate IS NULL),
neighbours AS (
  SELECT a.i, a.seq, a.label, a.quota,
         list(b.seq) FILTER (list_inner_product(a.v, b.v) >= {_THRESHOLD}) AS near
  FROM usable a LEFT JOIN usable b ON b.i < a.i GROUP BY a.i, a.seq, a.label, a.quota),
steps AS (
  SELECT CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS taken, CAST([] AS VARCHAR[]) AS taken_labels
  UNION ALL
  SELECT n.i,
         CASE WHEN {{ok}} THEN list_append(s.taken, n.seq) ELSE s.taken END,
         CASE WHEN {{ok}} THEN list_append(s.taken_labels, n.label) ELSE s.taken_labels END
  FROM steps s JOIN neighbours n ON n.i = s.i + 1),
final AS (SELECT taken FROM steps ORDER BY i DESC LIMIT 1),
accepted AS (SELECT seq, label FROM usable WHERE seq IN (SELECT unnest(taken) FROM final))
""".replace(
    "{ok}",
    f"len(s.taken) < {_T} AND len(list_filter(s.taken_labels, lambda x: x = n.label)) < n.quota "
    "AND NOT list_has_any(s.taken, coalesce(n.near, []))",
)
ORACLES["greedy_accept_with_seeds"] = "WITH RECURSIVE " + _GREEDY.replace(
    "WHERE gate IS NULL)",
    f"""WHERE gate IS NULL AND label <> '{data.SEED_CLASS}' AND NOT EXISTS (
      SELECT 1 FROM candidates s WHERE s.label = '{data.SEED_CLASS}' AND list_inner_product(gated.v, s.v) >= {_THRESHOLD}))""",
) + " SELECT seq, label FROM accepted"
ORACLES["greedy_accept"] = f"WITH RECURSIVE {_GREEDY} SELECT seq, label FROM accepted"
ORACLES["greedy_accept_all"] = f"""
WITH RECURSIVE
ordered AS (SELECT vec_id AS seq, CAST(embedding AS DOUBLE[]) AS v, row_number() OVER (ORDER BY vec_id) AS i FROM embeddings),
neighbours AS (
  SELECT a.i, a.seq, list(b.seq) FILTER (list_inner_product(a.v, b.v) >= {_THRESHOLD}) AS near
  FROM ordered a LEFT JOIN ordered b ON b.i < a.i GROUP BY a.i, a.seq),
steps AS (
  SELECT CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS taken
  UNION ALL
  SELECT n.i, CASE WHEN list_has_any(s.taken, coalesce(n.near, [])) THEN s.taken ELSE list_append(s.taken, n.seq) END
  FROM steps s JOIN neighbours n ON n.i = s.i + 1),
final AS (SELECT taken FROM steps ORDER BY i DESC LIMIT 1)
SELECT vec_id AS seq, CASE WHEN vec_id IN (SELECT unnest(taken) FROM final) THEN 'accepted' ELSE 'rejected' END AS status
FROM embeddings
"""
_OWN_PAIRS = re.sub(
    r"\b(sizes_l|sizes_r|frequency|ranked_l|ranked_r|prefix_l|prefix_r|pairs|shared|flagged)\b",
    r"own_\1",
    _near_pairs("sh_l", "sh_l", "r.doc_id < l.doc_id"),
)
ORACLES["greedy_accept_texts"] = f"""
WITH RECURSIVE {_ROLES}, {_shingles('synthetic', 'sh_l')}, {_shingles('seed', 'sh_r')},
{_near_pairs('sh_l', 'sh_r', 'true')}, {_OWN_PAIRS},
ordered AS MATERIALIZED (
  SELECT doc_id, doc_id IN (SELECT doc_id FROM flagged) AS of_seed, row_number() OVER (ORDER BY doc_id) AS i FROM synthetic),
held AS MATERIALIZED (SELECT a, list(b) AS near FROM own_shared WHERE 10 * common >= 9 * (na + nb - common) GROUP BY a),
steps AS (
  SELECT CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS taken
  UNION ALL
  SELECT o.i, CASE WHEN of_seed OR list_has_any(s.taken, coalesce(h.near, [])) THEN s.taken
                   ELSE list_append(s.taken, o.doc_id) END
  FROM steps s JOIN ordered o ON o.i = s.i + 1 LEFT JOIN held h ON h.a = o.doc_id),
final AS (SELECT taken FROM steps ORDER BY i DESC LIMIT 1)
SELECT doc_id AS seq, CASE WHEN doc_id IN (SELECT unnest(taken) FROM final) THEN 'accepted' ELSE 'rejected' END AS status
FROM synthetic
"""
_LEDGER = f"""
{_GREEDY},
cuts AS (
  SELECT label, max(seq) AS cut FROM accepted JOIN quotas USING (label) GROUP BY label, quota HAVING count(*) >= quota),
stop AS (SELECT CASE WHEN count(*) >= {_T} THEN max(seq) END AS stop_seq FROM accepted),
closed AS (SELECT label FROM quotas WHERE quota <= 0),
best AS (
  SELECT a.seq, max(list_inner_product(a.v, b.v)) AS max_similarity
  FROM gated a JOIN gated b ON b.seq < a.seq WHERE b.seq IN (SELECT seq FROM accepted) GROUP BY a.seq),
reasons AS (
  SELECT g.*, a.seq IS NOT NULL AS taken,
         CASE WHEN a.seq IS NOT NULL THEN NULL
              WHEN g.seq > stop_seq THEN 'target_reached'
              WHEN g.seq > cut OR g.label IN (SELECT label FROM closed) THEN 'quota_full'
              ELSE coalesce(gate, 'redundant') END AS reason
  FROM gated g LEFT JOIN accepted a USING (seq) LEFT JOIN cuts ON cuts.label = g.label, stop),
ledger AS (
  SELECT r.seq, r.label, cleaned_text AS text, CASE WHEN taken THEN 'accepted' ELSE 'rejected' END AS status, reason,
         overall_score, CASE WHEN taken OR reason = 'redundant' THEN max_similarity END AS max_similarity,
         CASE WHEN judge_status = 'judge_parse' THEN judge_raw_output END AS judge_raw_output
  FROM reasons r LEFT JOIN best USING (seq))
"""
ORACLES["sdg_ledger"] = f"""
WITH RECURSIVE {_LEDGER}
SELECT seq, label, text, status, reason, {rounded('overall_score', 'max_similarity')}, judge_raw_output FROM ledger
"""
ORACLES["sdg_manifest"] = f"""
WITH RECURSIVE {_LEDGER}
SELECT label, outcome, count(*) AS n
FROM (SELECT label, coalesce(reason, 'accepted') AS outcome FROM ledger) GROUP BY ROLLUP (label, outcome)
"""
ORACLES["loop_progress"] = f"""
WITH RECURSIVE {_GREEDY},
looped AS (
  SELECT label, 1 + least(CAST(floor(seq * 3 / CAST((SELECT count(*) FROM candidates) AS DOUBLE)) AS BIGINT), 2) AS loop FROM accepted),
added AS (SELECT loop, label, count(*) AS added FROM looped GROUP BY loop, label)
SELECT CAST(loop AS INTEGER) AS loop, label, added, CAST(sum(added) OVER (PARTITION BY label ORDER BY loop) AS BIGINT) AS collected FROM added
"""

# --- splits and training rows -------------------------------------------------------


def _halves(source: str) -> str:
    """CTEs up to ``halved``: rows of ``source`` (doc_id, text, label) halved to validation and test."""
    return f"""
h_counts AS (SELECT label, count(*) AS n FROM {source} GROUP BY label),
h_facts AS (SELECT sum(n) AS total, min(n) >= 2 AS strata FROM h_counts),
h_rows AS (
  SELECT s.*, CASE WHEN strata THEN label ELSE 'all' END AS grp, total - ceil(total * CAST(0.5 AS DOUBLE)) AS size, total
  FROM {source} s, h_facts),
h_exact AS (
  SELECT grp, any_value(size) AS size, CAST(count(*) AS DOUBLE) / any_value(total) * any_value(size) AS exact
  FROM h_rows GROUP BY grp),
h_ranked AS (
  SELECT grp, exact, size - sum(floor(exact)) OVER () AS left_over,
         row_number() OVER (ORDER BY floor(exact) - exact, grp) AS place
  FROM h_exact),
h_quota AS (SELECT grp, floor(exact) + CASE WHEN place <= left_over THEN 1 ELSE 0 END AS quota FROM h_ranked),
halved AS (
  SELECT doc_id, text, label, 'seed' AS source,
         CASE WHEN row_number() OVER (PARTITION BY grp ORDER BY {ROW_KEY}) <= quota THEN 'validation' ELSE 'test' END AS split
  FROM h_rows JOIN h_quota USING (grp))
"""


_PRIORITY = f"""
{_ROLES}, {_halves('seed')},
assigned AS (
  SELECT doc_id, text, label, 'synthetic' AS source, 'train' AS split FROM synthetic
  UNION ALL SELECT doc_id, text, label, source, split FROM halved)
"""
ORACLES["split_seed_priority"] = f"WITH {_PRIORITY} SELECT doc_id, label, source, split FROM assigned"
ORACLES["split_files_round_trip"] = f"""
WITH {_PRIORITY} SELECT split, label, count(*) AS n FROM assigned GROUP BY split, label
"""
ORACLES["seed_split_distribution"] = f"""
WITH {_ROLES}, {_CHECKED},
intake_seed AS (
  SELECT row_idx AS doc_id, text, label FROM valid WHERE row_idx IN (SELECT doc_id FROM labels)),
{_halves('intake_seed')},
assigned AS (SELECT label, 'train' AS split FROM synthetic UNION ALL SELECT label, split FROM halved)
SELECT split, label, count(*) AS n FROM assigned GROUP BY split, label
"""
ORACLES["union_sources"] = f"""
WITH {_ROLES}
SELECT 'synthetic' AS source, label, count(*) AS n FROM synthetic GROUP BY label
UNION ALL SELECT 'seed', label, count(*) FROM seed GROUP BY label
"""
ORACLES["stratifiable"] = f"""
WITH {_ROLES}, counts AS (SELECT label, count(*) AS n FROM seed GROUP BY label)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_labels, min(n) AS smallest_label, min(n) >= 2 AS stratifiable
FROM counts
"""

_HELD_OUT = f"CAST('{0.1 + 0.2!r}' AS DOUBLE)"
_TEST_SHARE = f"CAST('{0.2 / (0.1 + 0.2)!r}' AS DOUBLE)"


def _allocate(prefix: str, counts: str, second_share: str) -> str:
    """CTE ``{prefix}_quota``: rows of each label that go to the first part."""
    return f"""
{prefix}_total AS (SELECT sum(n) AS total FROM {counts}),
{prefix}_size AS (SELECT total, total - ceil(total * {second_share}) AS size FROM {prefix}_total),
{prefix}_exact AS (SELECT label, CAST(n AS DOUBLE) / total * size AS exact, size FROM {counts}, {prefix}_size),
{prefix}_ranked AS (
  SELECT label, exact, size - sum(floor(exact)) OVER () AS left_over,
         row_number() OVER (ORDER BY floor(exact) - exact, label) AS place
  FROM {prefix}_exact),
{prefix}_quota AS (SELECT label, floor(exact) + CASE WHEN place <= left_over THEN 1 ELSE 0 END AS quota FROM {prefix}_ranked)
"""


_THREE_WAY = f"""
{_ROLES},
counts AS (SELECT label, count(*) AS n FROM synthetic GROUP BY label),
{_allocate('a', 'counts', _HELD_OUT)},
held AS (SELECT label, n - quota AS n FROM counts JOIN a_quota USING (label)),
{_allocate('b', 'held', _TEST_SHARE)},
placed AS (
  SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY {ROW_KEY}) AS place FROM synthetic),
assigned AS (
  SELECT doc_id, p.label, CASE WHEN place <= a.quota THEN 'train' WHEN place <= a.quota + b.quota THEN 'validation'
                               ELSE 'test' END AS split
  FROM placed p JOIN a_quota a ON a.label = p.label JOIN b_quota b ON b.label = p.label)
"""
ORACLES["split_three_way"] = f"WITH {_THREE_WAY} SELECT doc_id, label, split FROM assigned"


def _count_list(split: str) -> str:
    return (
        f"(SELECT string_agg(label || '=' || n, '|' ORDER BY label) FROM per_split WHERE split = '{split}') AS {split}_labels"
    )


ORACLES["split_report"] = f"""
WITH {_THREE_WAY}, per_split AS (SELECT split, label, count(*) AS n FROM assigned GROUP BY split, label)
SELECT 'run_1' AS run_id, count(*) AS total_count, count(*) FILTER (split = 'train') AS train_count,
       count(*) FILTER (split = 'validation') AS val_count, count(*) FILTER (split = 'test') AS test_count,
       string_agg(DISTINCT label, '|' ORDER BY label) AS labels,
       {_count_list('train')}, {_count_list('validation')}, {_count_list('test')}
FROM assigned
"""

_NAMES = "names AS (SELECT string_agg(DISTINCT lang, ', ' ORDER BY lang) AS names FROM documents)"
_USER = fill(
    prompts.CLASSIFY_INSTRUCTION + "\n\nText: <<text>>", task=text(data.TASK), label_names="names", text="text"
)
ORACLES["sft_messages"] = f"""
WITH {_NAMES}
SELECT doc_id, {text(data.ROLE)} AS system_content, {_USER} AS user_content,
       '{{"label": ' || CAST(to_json(lang) AS VARCHAR) || '}}' AS assistant_content
FROM documents, names
"""
ORACLES["sft_verify"] = "SELECT lang AS target_label, true AS target_ok, count(*) AS n FROM documents GROUP BY lang"
ORACLES["dataset_hash"] = f"""
WITH rows AS (SELECT md5(text || chr(31) || lang) AS k FROM documents)
SELECT count(*) AS n_rows, CAST(sum({word('k', 0)}) AS VARCHAR) AS hash_high, CAST(sum({word('k', 1)}) AS VARCHAR) AS hash_low
FROM rows
"""

# --- trials -------------------------------------------------------------------------

_TRIALS = f"""
trials AS (SELECT {', '.join(f'{expr} AS {name}' for name, expr in data.TRIAL_COLUMNS.items())} FROM orders),
clean AS (
  SELECT run_id, number, value, state, params_learning_rate AS learning_rate, params_lora_r AS lora_r,
         params_lora_dropout AS lora_dropout FROM trials WHERE value IS NOT NULL),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY value, number) AS low,
         row_number() OVER (PARTITION BY run_id ORDER BY value DESC, number) AS high,
         count(*) OVER (PARTITION BY run_id) AS n_trials
  FROM clean)
"""
_MODEL_PATH = "'runs/' || run_id || '/training/output/trial_' || number"
ORACLES["trials_clean"] = f"""
WITH {_TRIALS}
SELECT run_id, number, value, state, learning_rate, lora_r, lora_dropout,
       CAST((learning_rate IS NOT NULL)::INT + (lora_r IS NOT NULL)::INT + (lora_dropout IS NOT NULL)::INT AS INTEGER) AS n_params
FROM clean
"""
ORACLES["best_trial"] = f"""
WITH {_TRIALS}
SELECT run_id, number AS best_trial_id, value AS best_value, state AS best_state, {_MODEL_PATH} AS best_model_path, n_trials
FROM ranked WHERE low = 1
"""
ORACLES["best_trial_maximize"] = f"""
WITH {_TRIALS} SELECT run_id, number AS best_trial_id, value AS best_value FROM ranked WHERE high = 1
"""
ORACLES["trial_summary"] = f"""
WITH {_TRIALS}, best AS (SELECT run_id, number AS best_trial_id, {_MODEL_PATH} AS best_model_path FROM ranked WHERE low = 1)
SELECT run_id, number AS trial_id, value AS metric_value, state AS status, best_trial_id, best_model_path
FROM clean JOIN best USING (run_id)
"""
ORACLES["final_params"] = f"""
WITH {_TRIALS}
SELECT run_id, number AS best_trial_id, 'base-model' AS model_name,
       coalesce(CAST(learning_rate AS DOUBLE), CAST(0.0001 AS DOUBLE)) AS learning_rate,
       2 AS per_device_train_batch_size, CAST(0.01 AS DOUBLE) AS weight_decay,
       coalesce(CAST(lora_r AS INTEGER), 8) AS lora_r, 16 AS lora_alpha,
       coalesce(CAST(lora_dropout AS DOUBLE), CAST(0.05 AS DOUBLE)) AS lora_dropout, 5 AS num_train_epochs,
       CAST(0.1 AS DOUBLE) AS warmup_ratio, 'adamw_torch' AS optimizer
FROM ranked WHERE low = 1
"""

# --- responses and evaluation -------------------------------------------------------

_LABELS = "label_set AS (SELECT list(DISTINCT lang ORDER BY lang) AS labels FROM documents)"


def snap(raw: str, compat: bool = False) -> str:
    low = f"lower({strip(raw)})"
    unusable = f"coalesce({raw}, '') = ''" if compat else f"coalesce({strip(raw)}, '') = ''"
    return (
        f"CASE WHEN {unusable} THEN 'unknown' ELSE coalesce(list_filter(labels, lambda v: lower(v) = {low})[1], "
        f"list_filter(labels, lambda v: contains(lower(v), {low}) OR contains({low}, lower(v)))[1], 'unknown') END"
    )


def _eval_parse(prefix: str, source: str, response: str) -> str:
    """CTEs up to ``{prefix}_parsed``: evaluation parse of ``response`` with raw_label and status."""
    return f"""
{prefix}_body AS (SELECT *, {strip(f"coalesce({response}, '')")} AS body FROM {source}),
{prefix}_cut AS (
  SELECT * REPLACE (
    CASE WHEN contains(body, '```json') THEN {strip("string_split(string_split(body, '```json')[2], '```')[1]")}
         WHEN contains(body, '{{') THEN regexp_extract(body, '(?s)\\{{.*\\}}') ELSE body END AS body)
  FROM {prefix}_body),
{prefix}_json AS (
  SELECT *, json_valid(body) AS is_valid, CASE WHEN json_valid(body) AND starts_with(body, '{{') THEN body ELSE '{{}}' END AS j
  FROM {prefix}_cut),
{prefix}_label AS (
  SELECT *, CASE WHEN list_contains(json_keys(j), 'label') THEN coalesce(json_extract_string(j, '$.label'), 'None') END AS found,
         CASE WHEN NOT is_valid THEN list_filter(string_split(body, chr(10)), lambda x: contains(x, '"label":'))[1] END AS line
  FROM {prefix}_json),
{prefix}_line AS (
  SELECT *, CASE WHEN line IS NOT NULL
                 THEN {strip("replace(replace(string_split(line, '\"label\":')[-1], '\"', ''), ',', '')")} END AS scanned
  FROM {prefix}_label),
{prefix}_parsed AS (
  SELECT *, coalesce(found, scanned, 'unknown') AS raw_label,
         CASE WHEN found IS NOT NULL THEN 'json' WHEN is_valid THEN 'no_label' WHEN scanned IS NOT NULL THEN 'line'
              ELSE 'failed' END AS raw_label_status
  FROM {prefix}_line)
"""


_REPLIES = f"replies AS (SELECT doc_id, lang, source, {data.reply('(' + data.PREDICTED + ')', 'doc_id')} AS response FROM documents)"
ORACLES["response_parse_eval"] = f"""
WITH {_LABELS}, {_REPLIES}, {_eval_parse('e', 'replies', 'response')}
SELECT doc_id, raw_label, raw_label_status, {snap('raw_label')} AS label FROM e_parsed, label_set
"""

_PAIR = """(?i)["'']?label["'']?\\s*[:=]\\s*["'']?([^"''\\s,{}]+)["'']?"""


def _object_label(body: str) -> str:
    safe = f"CASE WHEN json_valid({body}) AND starts_with({body}, '{{') THEN {body} ELSE '{{}}' END"
    return (
        f"CASE WHEN json_valid({body}) AND starts_with({body}, '{{') THEN CASE WHEN list_contains(json_keys({safe}), 'label') "
        f"THEN coalesce(json_extract_string({safe}, '$.label'), 'None') ELSE 'unknown' END END"
    )


_CASCADE = f"""
c_body AS (SELECT *, {strip("coalesce(response, '')")} AS body FROM replies),
c_block AS (SELECT *, {strip("replace(regexp_extract(body, '(?s)\\{.*\\}'), chr(10), ' ')")} AS block FROM c_body),
c_read AS (
  SELECT *, {_object_label('body')} AS whole, {_object_label('block')} AS inner_label,
         regexp_extract(body, '{_PAIR}', 1) AS pair,
         len(regexp_extract_all(body, '\\S+')) < 5 AND NOT contains(body, '{{') AS short
  FROM c_block),
c_parsed AS (
  SELECT *, CASE WHEN whole IS NOT NULL THEN whole WHEN inner_label IS NOT NULL THEN inner_label WHEN pair <> '' THEN pair
                 WHEN short THEN body ELSE 'ERROR: Parsing Failed' END AS raw_label,
         CASE WHEN whole IS NOT NULL THEN 'json' WHEN inner_label IS NOT NULL THEN 'block' WHEN pair <> '' THEN 'pair'
              WHEN short THEN 'short' ELSE 'failed' END AS raw_label_status
  FROM c_read)
"""
ORACLES["response_parse_cascade"] = f"""
WITH {_LABELS}, {_REPLIES}, {_CASCADE}
SELECT doc_id, raw_label, raw_label_status, {snap('raw_label')} AS label FROM c_parsed, label_set
"""
ORACLES["label_snap"] = f"""
WITH {_LABELS}, raw AS (
  SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN upper(lang) WHEN 1 THEN 'x' || lang || 'y' WHEN 2 THEN substr(lang, 1, 1)
                                 WHEN 3 THEN '  ' WHEN 4 THEN '' ELSE source END AS raw FROM documents)
SELECT doc_id, {snap('raw')} AS label, {snap('raw', True)} AS compat_label FROM raw, label_set
"""
ORACLES["parse_outcomes"] = f"""
WITH {_LABELS}, {_REPLIES}, {_eval_parse('e', 'replies', 'response')},
snapped AS (SELECT source, raw_label_status, {snap('raw_label')} AS label FROM e_parsed, label_set)
SELECT source, count(*) AS n_responses, round(avg(CASE WHEN raw_label_status = 'json' THEN 0.0 ELSE 1.0 END), 6) AS invalid_json_rate,
       round(avg(CASE WHEN label = 'unknown' THEN 1.0 ELSE 0.0 END), 6) AS unknown_rate
FROM snapped GROUP BY source
"""

_PAIRS = f"""
{_LABELS},
answers AS (SELECT doc_id, lang, {data.reply('(' + data.PREDICTED + ')', '(doc_id + 3)')} AS response FROM documents),
{_eval_parse('e', 'answers', 'response')},
pairs AS (SELECT doc_id, lang AS gt, {snap('raw_label')} AS pred, raw_label_status AS parse_status FROM e_parsed, label_set)
"""
ORACLES["eval_pairs"] = f"WITH {_PAIRS} SELECT doc_id, gt, pred, parse_status FROM pairs"
ORACLES["conversation_pairs"] = """
WITH ends AS (SELECT conv_id, min(turn) AS first_turn, max(turn) AS last_turn FROM conversations GROUP BY conv_id),
inner_turns AS (
  SELECT conv_id, min(turn) AS turn FROM conversations JOIN ends USING (conv_id)
  WHERE role = 'assistant' AND turn > first_turn AND turn < last_turn GROUP BY conv_id)
SELECT e.conv_id, g.text AS ground_truth, CASE WHEN p.role = 'assistant' THEN p.text END AS prediction
FROM ends e JOIN conversations p ON p.conv_id = e.conv_id AND p.turn = e.last_turn
LEFT JOIN inner_turns i ON i.conv_id = e.conv_id
LEFT JOIN conversations g ON g.conv_id = i.conv_id AND g.turn = i.turn
"""
ORACLES["eval_accuracy"] = f"""
WITH {_PAIRS} SELECT count(*) AS n_rows, round(avg(CASE WHEN gt = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pairs
"""
ORACLES["confusion_matrix"] = f"""
WITH {_PAIRS}, truth AS (SELECT DISTINCT gt FROM pairs), cells AS (SELECT gt, pred, count(*) AS n FROM pairs GROUP BY gt, pred)
SELECT a.gt AS actual, b.gt AS predicted, coalesce(n, 0) AS n
FROM truth a CROSS JOIN truth b LEFT JOIN cells c ON c.gt = a.gt AND c.pred = b.gt
"""
_METRICS = f"""
{_PAIRS},
seen AS (SELECT gt AS label FROM pairs UNION SELECT pred FROM pairs),
sums AS (
  SELECT label, (SELECT count(*) FROM pairs WHERE gt = label AND pred = label) AS tp,
         (SELECT count(*) FROM pairs WHERE gt = label) AS support, (SELECT count(*) FROM pairs WHERE pred = label) AS n_pred
  FROM seen),
metrics AS (
  SELECT label, CASE WHEN n_pred > 0 THEN tp / CAST(n_pred AS DOUBLE) ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN tp / CAST(support AS DOUBLE) ELSE 0.0 END AS recall,
         2.0 * tp / CAST(support + n_pred AS DOUBLE) AS f1, support
  FROM sums)
"""
ORACLES["label_metrics"] = f"""
WITH {_METRICS} SELECT label, {rounded('precision', 'recall', 'f1')}, support FROM metrics WHERE support > 0
"""
ORACLES["macro_f1"] = f"WITH {_METRICS} SELECT count(*) AS n_labels, round(avg(f1), 6) AS macro_f1 FROM metrics"
ORACLES["eval_report"] = f"""
WITH {_METRICS}, truth AS (SELECT DISTINCT gt FROM pairs), cells AS (SELECT gt, pred, count(*) AS n FROM pairs GROUP BY gt, pred),
grid AS (
  SELECT a.gt AS actual, string_agg(CAST(coalesce(n, 0) AS VARCHAR), ',' ORDER BY b.gt) AS line
  FROM truth a CROSS JOIN truth b LEFT JOIN cells c ON c.gt = a.gt AND c.pred = b.gt GROUP BY a.gt)
SELECT (SELECT round(avg(CASE WHEN gt = pred THEN 1.0 ELSE 0.0 END), 6) FROM pairs) AS accuracy,
       (SELECT round(avg(f1), 6) FROM metrics) AS macro_f1,
       (SELECT round(avg(CASE WHEN parse_status = 'json' THEN 0.0 ELSE 1.0 END), 6) FROM pairs) AS invalid_json_rate,
       (SELECT round(avg(CASE WHEN pred = 'unknown' THEN 1.0 ELSE 0.0 END), 6) FROM pairs) AS unknown_rate,
       (SELECT string_agg(line, '|' ORDER BY actual) FROM grid) AS confusion_matrix,
       (SELECT string_agg(gt, '|' ORDER BY gt) FROM truth) AS labels,
       CAST((SELECT count(*) FROM truth) AS INTEGER) AS n_label_metrics
"""

# --- inference ----------------------------------------------------------------------

ORACLES["inference_requests"] = f"""
WITH {_NAMES}
SELECT doc_id, {_USER} AS user_content, {text(data.ROLE + ' ')} || {_USER} AS prompt FROM documents, names
"""
ORACLES["request_guard"] = f"""
WITH rows AS (SELECT doc_id, coalesce({strip('(' + data.RAW_TEXT + ')')}, '') = '' AS blank FROM documents)
SELECT doc_id, NOT blank AS needs_model, CASE WHEN blank THEN 'No input provided.' END AS label,
       CASE WHEN blank THEN CAST(0 AS DOUBLE) END AS confidence, CASE WHEN blank THEN '' END AS raw_output
FROM rows
"""
ORACLES["token_confidence"] = """
SELECT vec_id, round(list_avg(list_transform(embedding, lambda x: exp(-abs(CAST(x AS DOUBLE))))), 6) AS confidence FROM embeddings
"""
ORACLES["inference_responses"] = f"""
WITH {_LABELS}, {_REPLIES}, {_CASCADE}
SELECT doc_id, {snap('raw_label')} AS label,
       round((exp(-(doc_id % 7) / CAST(10.0 AS DOUBLE)) + exp(CAST(-0.5 AS DOUBLE))) / 2, 6) AS confidence,
       response AS raw_output, CASE WHEN raw_label_status = 'failed' THEN 'ERROR: Parsing Failed' END AS error
FROM c_parsed, label_set
"""
