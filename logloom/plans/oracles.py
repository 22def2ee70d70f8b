"""DuckDB statements that compute the same results as the queries, over the same tables.

They spell the semantics out with dense grids and plain windows, so they also check the
sparse and range-wise forms used on Spark.
"""

from __future__ import annotations

from logloom.functions.formats import BLOCK_LOG, VM_LOG, LogFormat
from logloom.functions.text import _EXOTIC, _UNEVEN, STRIP_SET
from logloom.sources.samples import QUANTITY_STEPS

ORACLES: dict[str, str] = {}

BLOCK = """
rendered AS (
  SELECT event_id + 1 AS LineId, 'block.log' AS source, 1 AS source_order,
    CASE WHEN event_id % 97 = 0 THEN content ELSE header || content END AS value
  FROM (
    SELECT event_id,
      strftime(ts, '%y%m%d %H%M%S') || ' ' || (event_id % 100) || ' '
        || CASE WHEN event_type = 'error' THEN 'WARN' ELSE 'INFO' END || ' dfs.' || event_type || ': ' AS header,
      CASE event_type
        WHEN 'click' THEN 'Receiving block ' || blk || ' src: /' || host || ':' || (50000 + event_id % 1000)
        WHEN 'view' THEN 'Served block ' || blk || ' to /' || host
        WHEN 'purchase' THEN 'PacketResponder ' || (event_id % 3) || ' for block ' || blk || ' terminating'
        WHEN 'error' THEN 'Exception writing ' || blk || ' to mirror'
        ELSE 'Verification succeeded' END AS content
    FROM (
      SELECT *, 'blk_' || CASE WHEN user_id % 2 = 0 THEN '-' ELSE '' END || user_id AS blk,
        '10.0.0.' || (user_id % 256) AS host FROM events)))"""

VM = """
rendered AS (
  SELECT event_id + 1 AS LineId, source, source_order,
    CASE WHEN event_id % 97 = 0 THEN content
      ELSE source || ' ' || stamp || ' ' || (event_id % 100) || ' '
        || CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END || ' nova.' || event_type || ' '
        || CASE WHEN event_id % 11 = 0 THEN '' ELSE '[req-' || event_id || '] ' END || content END AS value
  FROM (
    SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S.') || substr(strftime(ts, '%f'), 1, 3) AS stamp,
      ['normal1.log', 'normal2.log', 'abnormal.log'][source_order] AS source,
      '[instance: vm-' || user_id || '] ' || CASE event_type
        WHEN 'click' THEN 'VM Started (Lifecycle Event)'
        WHEN 'view' THEN 'Took ' || (event_id % 60) || '.' || (event_id % 100) || ' seconds to build instance.'
        WHEN 'purchase' THEN 'Attempting claim: memory ' || (event_id % 4096) || ' MB, disk 20 GB, vcpus 1 CPU'
        WHEN 'error' THEN 'Instance failed to spawn on host 10.1.0.' || (user_id % 256)
        ELSE 'Terminating instance' END AS content
    FROM (SELECT *, CASE WHEN user_id % 5 = 0 THEN 3 ELSE event_id % 2 + 1 END AS source_order FROM events)))"""

DOCUMENT = """
rendered AS (
  SELECT 'doc-' || doc_id AS source, doc_id AS source_order,
    unnest(string_split(text, chr(10))) AS value,
    generate_subscripts(string_split(text, chr(10)), 1) AS LineId
  FROM documents)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


CLEAN = f"""
cleaned AS (
  SELECT * REPLACE (trim(value, {_quoted(STRIP_SET)}) AS value) FROM rendered
  WHERE regexp_matches(value, {_quoted(f'[^{_EXOTIC} ]')}))"""


def _parsed(fmt: LogFormat) -> str:
    rx = _quoted("(?s)" + fmt.header)
    fields = ",\n    ".join(
        f"CASE WHEN regexp_matches(value, {rx}) THEN regexp_extract(value, {rx}, {i}) ELSE "
        + ("value" if name == "Content" else "''")
        + f" END AS {name}"
        for i, name in enumerate(fmt.fields, 1)
    )
    return f"""{CLEAN},
parsed AS (
  SELECT *, nullif(regexp_extract(Content, {_quoted(fmt.entity)}, 1), '') AS {fmt.entity_col}
  FROM (SELECT source, source_order, LineId, regexp_matches(value, {rx}) AS is_parsed,
    {fields} FROM cleaned))"""


def _masked(column: str, fmt: LogFormat = BLOCK_LOG) -> str:
    for rule in fmt.masks:
        column = f"regexp_replace({column}, {_quoted(rule.pattern)}, {_quoted(rule.token)}, 'g')"
    return column


def _even(column: str) -> str:
    return f"trim(regexp_replace({column}, {_quoted(_UNEVEN)}, ' ', 'g'), ' ')"


SIGNED = f"""
signed AS (
  SELECT *, {_even(_masked('Content'))} AS signature, source_order::BIGINT * 1099511627776 + LineId AS seen_at FROM parsed)"""
UNMASKED = f"""
signed AS (
  SELECT *, regexp_replace({_even('Content')}, '(^| )[^ \\d]*\\d[^ ]*', '\\1<*>', 'g') AS signature,
    source_order::BIGINT * 1099511627776 + LineId AS seen_at FROM parsed)"""
SIGNATURES = """
signatures AS (SELECT signature, count(*) AS lines, min(seen_at) AS seen_at FROM signed GROUP BY signature)"""
TEMPLATES = f"""{SIGNATURES},
templates AS (
  SELECT signature, row_number() OVER (ORDER BY seen_at) AS event_no, 'E' || row_number() OVER (ORDER BY seen_at) AS EventId,
    signature AS EventTemplate, lines AS Occurrences FROM signatures),
structured AS (SELECT s.*, EventId, EventTemplate FROM signed s JOIN templates USING (signature))"""
BLOCK_PARSED = f"{BLOCK},{_parsed(BLOCK_LOG)}"
VM_PARSED = f"{VM},{_parsed(VM_LOG)}"
DOCUMENT_PARSED = f"{DOCUMENT},{_parsed(BLOCK_LOG)}"
VM_EVENTS = f"{VM_PARSED},{SIGNED},{TEMPLATES}"
COUNTS = f"""{BLOCK_PARSED},{SIGNED},{TEMPLATES},
counts AS (
  SELECT BlockId AS entity_id, EventId AS event_id, count(*) AS n FROM structured
  WHERE BlockId IS NOT NULL GROUP BY ALL),
totals AS (SELECT entity_id, sum(n)::BIGINT AS total_events FROM counts GROUP BY entity_id),
labels_of AS (
  SELECT DISTINCT 'blk_' || CASE WHEN user_id % 2 = 0 THEN '-' ELSE '' END || user_id AS entity_id,
    CASE WHEN user_id % 10 = 3 THEN 'Anomaly' ELSE 'Normal' END AS label
  FROM events WHERE user_id % 10 != 7),
labelled AS (SELECT t.*, label FROM totals t LEFT JOIN labels_of USING (entity_id)),
matrix AS (
  SELECT entity_id, {', '.join(f"coalesce(sum(n) FILTER (event_id = 'E{i}'), 0)::BIGINT AS E{i}" for i in range(1, 6))},
    sum(n)::BIGINT AS total_events FROM counts GROUP BY entity_id),
labelled_matrix AS (SELECT m.*, label FROM matrix m LEFT JOIN labels_of USING (entity_id))"""

_LAST = len(QUANTITY_STEPS)
QUANTITY = f"""
facts AS (
  SELECT 'p' || l_partkey AS entity_id, 'E' || step_no AS event_id, step_no
  FROM lineitem JOIN (SELECT unnest({list(QUANTITY_STEPS)}) AS step, unnest(range(1, {_LAST + 1})) AS step_no)
    ON l_quantity > step),
counts AS (SELECT entity_id, event_id, count(*) AS n FROM facts GROUP BY ALL),
entities AS (SELECT DISTINCT entity_id FROM counts),
steps AS (SELECT 'E' || i AS event_id, i AS event_no FROM range(1, {_LAST + 1}) t(i)),
grid AS (
  SELECT entity_id, event_id, event_no, coalesce(n, 0) AS n
  FROM entities CROSS JOIN steps LEFT JOIN counts USING (entity_id, event_id)),
variances AS (SELECT event_id, event_no, var_samp(n) AS variance FROM grid GROUP BY ALL),
pairs AS (
  SELECT a.event_id AS event_a, b.event_id AS event_b, a.event_no AS no_a, b.event_no AS no_b,
    CASE WHEN var_pop(a.n) = 0 OR var_pop(b.n) = 0 THEN NULL ELSE corr(a.n, b.n) END AS r
  FROM grid a JOIN grid b ON a.entity_id = b.entity_id AND a.event_no < b.event_no GROUP BY ALL)"""

SCORES = """
scores AS (
  SELECT event_id, event_id % 10 + 1 AS fold, (event_type = 'error')::INT AS target, model, score,
    (score >= 0.25)::INT AS prediction
  FROM (SELECT *, 'Logistic Regression' AS model, floor(value)::BIGINT / 100 AS score FROM events
    UNION ALL SELECT *, 'Random Forest' AS model, (event_id * 7919 % 1000) / 1000 AS score FROM events)),
cells AS (
  SELECT model, fold, count(*) FILTER (target = 0 AND prediction = 0) AS tn, count(*) FILTER (target = 0 AND prediction = 1) AS fp,
    count(*) FILTER (target = 1 AND prediction = 0) AS fn, count(*) FILTER (target = 1 AND prediction = 1) AS tp
  FROM scores GROUP BY ALL),
pr AS (
  SELECT model, fold, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
    coalesce(tp / nullif(tp + (fp + fn) / 2, 0), 0) AS f1 FROM cells),
ranked AS (
  SELECT *, rank() OVER w + (count(*) OVER (PARTITION BY model, fold, score) - 1) / 2 AS place
  FROM scores WINDOW w AS (PARTITION BY model, fold ORDER BY score)),
auc AS (
  SELECT model, fold, (sum(place) FILTER (target = 1) - sum(target) * (sum(target) + 1) / 2)
    / nullif(sum(target) * (count(*) - sum(target)), 0) AS auc
  FROM ranked GROUP BY ALL),
summary AS (
  SELECT model, count(*) AS folds, avg(precision) AS mean_precision, avg(recall) AS mean_recall, avg(auc) AS mean_auc,
    stddev_pop(precision) AS std_precision, stddev_pop(recall) AS std_recall, stddev_pop(auc) AS std_auc
  FROM pr JOIN auc USING (model, fold) GROUP BY model)"""

LEDGER = """
ledger AS (
  SELECT 'u' || user_id || '.log' AS source, user_id, md5(event_id::VARCHAR) AS fingerprint, event_id AS num_lines,
    event_id % 50 AS num_templates, event_id % 7 = 3 AS cleared, event_id FROM events),
latest AS (
  SELECT source, fingerprint, num_lines, num_templates FROM ledger
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY event_id DESC) = 1 AND NOT cleared)"""

TAGGED = f"""{VM_PARSED},
first_source AS (
  SELECT InstanceId AS entity_id, min(source_order) AS source_order FROM parsed WHERE InstanceId IS NOT NULL GROUP BY ALL),
vm_labels AS (
  SELECT entity_id, CASE WHEN entity_id IN (SELECT 'vm-' || user_id FROM events WHERE user_id % 10 = 3) THEN 'Anomaly'
    WHEN source_order = 3 THEN 'Anomaly' ELSE 'Normal' END AS label FROM first_source)"""


def _sql(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


def _add(name: str, ctes: str, select: str) -> None:
    ORACLES[name] = _sql(ctes, select)


_uuid = "substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12)"
_vm_fields = ", ".join(VM_LOG.fields)
_block_fields = ", ".join(BLOCK_LOG.fields)

# Sources
_add("scan_lines", f"{DOCUMENT},{CLEAN}", "SELECT source, LineId, value FROM cleaned")
_add(
    "line_number",
    BLOCK,
    "SELECT part, dense_rank() OVER (ORDER BY 'part=' || part) AS source_order, LineId - part * 4000 AS LineId, value "
    "FROM (SELECT (LineId - 1) // 4000 AS part, * FROM rendered)",
)
_add(
    "label_ids_from_text",
    "hashed AS (SELECT md5(user_id::VARCHAR) AS h FROM events WHERE user_id % 10 = 3)",
    f"SELECT DISTINCT {_uuid} AS entity_id FROM hashed",
)
_add(
    "tagged_union",
    VM,
    "SELECT source, CASE source WHEN 'abnormal.log' THEN 'Anomaly' ELSE 'Normal' END AS source_label, count(*) AS lines, "
    "sum(LineId)::BIGINT AS line_sum FROM rendered GROUP BY ALL",
)
_add(
    "source_fingerprint",
    f"{VM}, hashed AS (SELECT *, cast('0x' || substr(md5(value), 1, 15) AS BIGINT)::HUGEINT AS h FROM rendered)",
    "SELECT source, count(*) AS num_lines, sum(h)::VARCHAR || '-' || sum(h * LineId)::VARCHAR AS fingerprint "
    "FROM hashed GROUP BY source",
)
_add("ledger_latest", LEDGER, "SELECT * FROM latest")
_add(
    "ingest_plan",
    f"""{LEDGER},
present AS (
  SELECT 'u' || user_id || '.log' AS source, user_id % 3 != 0 AS there,
    CASE WHEN user_id % 4 = 1 THEN 'changed' ELSE md5(max(event_id)::VARCHAR) END AS fingerprint
  FROM events GROUP BY user_id)""",
    """SELECT p.source, CASE WHEN NOT there AND l.source IS NOT NULL THEN 'archived' WHEN NOT there THEN 'missing'
    WHEN l.source IS NULL THEN 'parse' WHEN p.fingerprint = l.fingerprint THEN 'skip' ELSE 'reparse' END AS decision,
  CASE WHEN there THEN p.fingerprint END AS fingerprint, num_lines AS known_lines, num_templates AS known_templates
FROM present p LEFT JOIN latest l USING (source)""",
)

# Parsing and scalar functions
_add("parse_block_logs", BLOCK_PARSED, f"SELECT LineId, {_block_fields}, BlockId, is_parsed FROM parsed")
_add("parse_vm_logs", VM_PARSED, f"SELECT source, LineId, {_vm_fields}, InstanceId, is_parsed FROM parsed")
_add("unparsed_lines", VM_PARSED, f"SELECT source, LineId, {_vm_fields}, InstanceId FROM parsed WHERE NOT is_parsed")
_add(
    "entity_extract_block",
    BLOCK,
    f"SELECT LineId, nullif(regexp_extract(value, {_quoted(BLOCK_LOG.entity)}, 1), '') AS entity_id FROM rendered",
)
_add(
    "entity_extract_all",
    f"""{BLOCK_PARSED},
named AS (
  SELECT LineId, list_distinct(regexp_extract_all(Content || ' after blk_' || (LineId % 20), {_quoted(BLOCK_LOG.entity)}, 1)) AS ids
  FROM parsed)""",
    "SELECT LineId, unnest(ids) AS entity_id FROM named",
)
_add(
    "entity_extract_instance",
    VM,
    f"SELECT LineId, nullif(regexp_extract(value, {_quoted(VM_LOG.entity)}, 1), '') AS entity_id FROM rendered",
)
_add("mask_content", BLOCK_PARSED, f"SELECT LineId, {_masked('Content')} AS masked FROM parsed")
_add(
    "binary_target",
    COUNTS,
    "SELECT entity_id, label, coalesce(label = 'Anomaly', false)::INT AS target FROM labelled",
)
_add(
    "template_preview",
    f"{DOCUMENT},{CLEAN}",
    "SELECT source, LineId, CASE WHEN length(value) > 70 THEN substr(value, 1, 70) || '...' ELSE value END AS preview FROM cleaned",
)

# Template mining
_add(
    "token_shape",
    f"{VM_PARSED},{SIGNED}",
    "SELECT LineId, CASE WHEN signature = '' THEN 0 ELSE len(string_split(signature, ' ')) END AS n_tokens, "
    "regexp_replace(signature, '(^| )[^ \\d]*\\d[^ ]*', '\\1<*>', 'g') AS leaf_tokens FROM signed",
)
_add("signature_counts", f"{VM_PARSED},{SIGNED},{SIGNATURES}", "SELECT * FROM signatures")
_add("signature_counts_unmasked", f"{VM_PARSED},{UNMASKED},{SIGNATURES}", "SELECT * FROM signatures")
_add(
    "template_leaf",
    f"""{DOCUMENT_PARSED},{SIGNED},{SIGNATURES},
headed AS (
  SELECT *, len(string_split(signature, ' ')) AS n_tokens, string_split(signature, ' ')[1] AS first_token FROM signatures),
wild AS (SELECT *, CASE WHEN regexp_matches(first_token, '\\d') THEN '<*>' ELSE first_token END AS head FROM headed),
kept AS (
  SELECT n_tokens, head FROM wild WHERE head != '<*>' GROUP BY n_tokens, head
  QUALIFY row_number() OVER (PARTITION BY n_tokens ORDER BY min(seen_at)) <= 4)""",
    "SELECT signature, w.n_tokens, coalesce(k.head, '<*>') AS head FROM wild w LEFT JOIN kept k USING (n_tokens, head)",
)


def _hits(left: str, right: str) -> str:
    return f"len(list_filter(list_zip({left}, {right}), lambda z: z[1] = z[2] AND z[1] != '<*>'))"


# Signatures one by one in order of appearance: each joins the leaders of its leaf or becomes one.
MINED = f"""{SIGNATURES},
split AS (
  SELECT *, CASE WHEN signature = '' THEN [] ELSE string_split(signature, ' ') END AS tokens FROM signatures),
wild AS (
  SELECT *, len(tokens) AS n_tokens,
    CASE WHEN regexp_matches(tokens[1], '\\d') THEN '<*>' ELSE tokens[1] END AS head FROM split),
kept AS (
  SELECT n_tokens, head FROM wild WHERE head != '<*>' GROUP BY n_tokens, head
  QUALIFY row_number() OVER (PARTITION BY n_tokens ORDER BY min(seen_at)) <= 99),
leafed AS (
  SELECT w.* REPLACE (coalesce(k.head, '<*>') AS head),
    row_number() OVER (PARTITION BY w.n_tokens, coalesce(k.head, '<*>') ORDER BY seen_at) AS i
  FROM wild w LEFT JOIN kept k ON w.n_tokens = k.n_tokens AND w.head = k.head),
walk AS (
  SELECT n_tokens, head, i, seen_at, true AS leads, [tokens] AS leaders FROM leafed WHERE i = 1
  UNION ALL
  SELECT n_tokens, head, i, seen_at, NOT covered, CASE WHEN covered THEN leaders ELSE list_append(leaders, tokens) END
  FROM (
    SELECT l.*, w.leaders, len(list_filter(w.leaders, lambda x: {_hits('x', 'l.tokens')} / greatest(len(x), 1) >= 0.4)) > 0 AS covered
    FROM walk w JOIN leafed l ON l.n_tokens = w.n_tokens AND l.head = w.head AND l.i = w.i + 1)),
led AS (SELECT l.* FROM leafed l JOIN walk w USING (seen_at) WHERE leads),
chosen AS (
  SELECT s.signature, s.tokens, s.lines, s.seen_at, l.seen_at AS leader_seen
  FROM leafed s JOIN led l ON s.n_tokens = l.n_tokens AND s.head = l.head
  QUALIFY row_number() OVER (PARTITION BY s.signature
    ORDER BY CASE WHEN s.signature = l.signature THEN 1000000 ELSE {_hits('s.tokens', 'l.tokens')} END DESC, l.seen_at) = 1),
groups AS (
  SELECT leader_seen, row_number() OVER (ORDER BY min(seen_at)) AS event_no, sum(lines)::BIGINT AS Occurrences
  FROM chosen GROUP BY leader_seen),
positions AS (
  SELECT leader_seen, pos, CASE WHEN min(token) = max(token) THEN min(token) ELSE '<*>' END AS token
  FROM (SELECT leader_seen, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM chosen) GROUP BY ALL),
texts AS (SELECT leader_seen, string_agg(token, ' ' ORDER BY pos) AS EventTemplate FROM positions GROUP BY leader_seen)"""
_add(
    "template_groups",
    f"RECURSIVE {DOCUMENT_PARSED},{SIGNED},{MINED}",
    "SELECT signature, lines, event_no, 'E' || event_no AS EventId FROM chosen JOIN groups USING (leader_seen)",
)
_add(
    "template_table",
    f"RECURSIVE {VM_PARSED},{SIGNED},{MINED}",
    "SELECT event_no, 'E' || event_no AS EventId, EventTemplate, Occurrences FROM groups JOIN texts USING (leader_seen)",
)
# Mining on top of a dictionary: the first two sources give it (MINED over their lines), then all lines come.
GROWN = f"""{MINED.replace("FROM signed", "FROM (FROM signed WHERE source_order < 3)")},
known AS (
  SELECT g.event_no, g.leader_seen, l.signature, l.tokens, l.n_tokens, l.head, t.EventTemplate
  FROM groups g JOIN led l ON l.seen_at = g.leader_seen JOIN texts t ON t.leader_seen = g.leader_seen),
signatures_2 AS (SELECT signature, count(*) AS lines, min(seen_at) AS seen_at FROM signed GROUP BY signature),
split_2 AS (SELECT *, CASE WHEN signature = '' THEN [] ELSE string_split(signature, ' ') END AS tokens FROM signatures_2),
wild_2 AS (
  SELECT *, len(tokens) AS n_tokens, CASE WHEN regexp_matches(tokens[1], '\\d') THEN '<*>' ELSE tokens[1] END AS head FROM split_2),
kept_2 AS (
  SELECT n_tokens, head FROM (
    SELECT n_tokens, head, 0 AS late, event_no AS place FROM known UNION ALL SELECT n_tokens, head, 1, seen_at FROM wild_2)
  WHERE head != '<*>' GROUP BY n_tokens, head
  QUALIFY row_number() OVER (PARTITION BY n_tokens ORDER BY min(late), min(place)) <= 99),
leafed_2 AS (
  SELECT w.* REPLACE (coalesce(k.head, '<*>') AS head) FROM wild_2 w LEFT JOIN kept_2 k ON w.n_tokens = k.n_tokens AND w.head = k.head),
scored_2 AS (
  SELECT s.signature, s.tokens, s.lines, s.seen_at, k.event_no,
    CASE WHEN s.signature = k.signature THEN s.n_tokens + 1 ELSE {_hits('s.tokens', 'k.tokens')} END AS hits, s.n_tokens
  FROM leafed_2 s JOIN known k ON s.n_tokens = k.n_tokens AND s.head = k.head),
matched AS (
  SELECT * FROM scored_2 WHERE hits > n_tokens OR hits / greatest(n_tokens, 1) >= 0.4
  QUALIFY row_number() OVER (PARTITION BY signature ORDER BY hits DESC, event_no) = 1),
open_2 AS (
  SELECT *, row_number() OVER (PARTITION BY n_tokens, head ORDER BY seen_at) AS i FROM leafed_2 WHERE signature NOT IN (SELECT signature FROM matched)),
walk_2 AS (
  SELECT n_tokens, head, i, seen_at, true AS leads, [tokens] AS leaders FROM open_2 WHERE i = 1
  UNION ALL
  SELECT n_tokens, head, i, seen_at, NOT covered, CASE WHEN covered THEN leaders ELSE list_append(leaders, tokens) END
  FROM (
    SELECT l.*, w.leaders, len(list_filter(w.leaders, lambda x: {_hits('x', 'l.tokens')} / greatest(len(x), 1) >= 0.4)) > 0 AS covered
    FROM walk_2 w JOIN open_2 l ON l.n_tokens = w.n_tokens AND l.head = w.head AND l.i = w.i + 1)),
led_2 AS (SELECT l.* FROM open_2 l JOIN walk_2 w USING (seen_at) WHERE leads),
chosen_2 AS (
  SELECT s.signature, s.tokens, s.lines, s.seen_at, l.seen_at AS leader_seen
  FROM open_2 s JOIN led_2 l ON s.n_tokens = l.n_tokens AND s.head = l.head
  QUALIFY row_number() OVER (PARTITION BY s.signature
    ORDER BY CASE WHEN s.signature = l.signature THEN 1000000 ELSE {_hits('s.tokens', 'l.tokens')} END DESC, l.seen_at) = 1),
groups_2 AS (
  SELECT leader_seen, row_number() OVER (ORDER BY min(seen_at)) + (SELECT max(event_no) FROM known) AS event_no FROM chosen_2 GROUP BY leader_seen),
members AS (
  SELECT event_no, tokens, lines FROM matched
  UNION ALL SELECT event_no, tokens, lines FROM chosen_2 JOIN groups_2 USING (leader_seen)
  UNION ALL SELECT event_no, CASE WHEN EventTemplate = '' THEN [] ELSE string_split(EventTemplate, ' ') END, 0 FROM known),
positions_2 AS (
  SELECT event_no, pos, CASE WHEN min(token) = max(token) THEN min(token) ELSE '<*>' END AS token
  FROM (SELECT event_no, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM members) GROUP BY ALL),
texts_2 AS (SELECT event_no, string_agg(token, ' ' ORDER BY pos) AS EventTemplate FROM positions_2 GROUP BY event_no)"""
_add(
    "template_increment",
    f"RECURSIVE {VM_PARSED},{SIGNED},{GROWN}",
    "SELECT event_no, 'E' || event_no AS EventId, coalesce(EventTemplate, '') AS EventTemplate, sum(lines)::BIGINT AS Occurrences "
    "FROM members LEFT JOIN texts_2 USING (event_no) GROUP BY ALL",
)
_add("template_table_exact", VM_EVENTS, "SELECT event_no, EventId, EventTemplate, Occurrences FROM templates")
_add("line_events", VM_EVENTS, "SELECT LineId, EventId, EventTemplate FROM structured")

# Labels
_add("label_join", COUNTS, "SELECT * FROM labelled")
_add("label_precedence", TAGGED, "SELECT * FROM vm_labels")
_add("label_default", COUNTS, "SELECT * REPLACE (coalesce(label, 'Unknown') AS label) FROM labelled")

# Counts and matrix
_add("entity_event_counts", COUNTS, "SELECT * FROM counts")
_add("occurrence_matrix", COUNTS, "SELECT * EXCLUDE (total_events) FROM matrix")
_add("labelled_matrix", COUNTS, "SELECT * FROM labelled_matrix")
_add(
    "vm_labelled_matrix",
    f"{TAGGED},{SIGNED},{TEMPLATES}",
    "SELECT InstanceId AS entity_id, "
    + ", ".join(f"count(*) FILTER (EventId = 'E{i}') AS E{i}" for i in range(1, 11))
    + ", count(*) AS total_events, any_value(label) AS label "
    "FROM structured JOIN vm_labels ON InstanceId = entity_id GROUP BY InstanceId",
)
_add(
    "dropped_events",
    QUANTITY,
    "SELECT event_id, sum(n)::BIGINT AS n FROM counts WHERE event_id NOT IN ('E1', 'E2', 'E5') GROUP BY event_id",
)
_add("entity_totals", COUNTS, "SELECT * FROM totals")
_add(
    "matrix_density",
    QUANTITY,
    "SELECT count(DISTINCT entity_id) AS entities, count(DISTINCT event_id) AS events, count(*) FILTER (n > 0) AS nonzero, "
    "round(100.0::DOUBLE * count(*) FILTER (n > 0) / count(*), 6) AS density_pct FROM grid",
)
_add(
    "total_summary",
    f"{QUANTITY}, totals AS (SELECT entity_id, sum(n)::BIGINT AS total FROM counts GROUP BY entity_id)",
    "SELECT count(*) AS entities, round(avg(total), 6) AS mean_events, min(total) AS min_events, max(total) AS max_events, "
    "round(median(total), 6) AS median_events FROM totals",
)

# Profiles
_add(
    "top_events",
    QUANTITY,
    "SELECT row_number() OVER (ORDER BY sum(n) DESC, substr(event_id, 2)::INT)::INT AS rank, event_id, sum(n)::BIGINT AS n, "
    "round(sum(n) * 100.0::DOUBLE / (SELECT sum(n) FROM counts), 6) AS pct FROM counts GROUP BY event_id "
    "ORDER BY rank LIMIT 10",
)
_add(
    "rare_events",
    QUANTITY,
    "SELECT event_id, sum(n)::BIGINT AS n FROM counts GROUP BY event_id ORDER BY 2, substr(event_id, 2)::INT LIMIT 5",
)
_add(
    "label_distribution",
    COUNTS,
    "SELECT label, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(label) FROM labelled), 6) AS pct "
    "FROM labelled WHERE label IS NOT NULL GROUP BY label",
)
_add(
    "class_ratio",
    COUNTS,
    "SELECT count(*) FILTER (label = 'Normal') AS negatives, count(*) FILTER (label = 'Anomaly') AS positives, "
    "round(count(*) FILTER (label = 'Normal') / nullif(count(*) FILTER (label = 'Anomaly'), 0), 6) AS ratio FROM labelled",
)
_add(
    "majority_ratio",
    f"{COUNTS}, sizes AS (SELECT count(*) AS n FROM labelled WHERE label IS NOT NULL GROUP BY label)",
    "SELECT max(n) AS largest, min(n) AS second, round(max(n) / min(n), 6) AS ratio FROM sizes",
)
_add(
    "anomaly_rate",
    COUNTS,
    "SELECT count(*) AS entities, count(*) FILTER (label = 'Anomaly') AS anomalies, "
    "round(count(*) FILTER (label = 'Anomaly') * 100.0::DOUBLE / count(*), 6) AS rate_pct FROM labelled",
)
_add(
    "entity_coverage", VM_PARSED, "SELECT count(InstanceId) AS entity_lines, count(DISTINCT InstanceId) AS entities FROM parsed"
)
_add(
    "parse_stats",
    VM_EVENTS,
    "SELECT count(*) AS lines, count(*) FILTER (is_parsed) AS parsed_lines, count(DISTINCT EventId) AS templates FROM structured",
)
_add(
    "top_templates",
    VM_EVENTS,
    "SELECT EventId, Occurrences, CASE WHEN length(EventTemplate) > 70 THEN substr(EventTemplate, 1, 70) || '...' "
    "ELSE EventTemplate END AS preview FROM templates ORDER BY Occurrences DESC, event_no LIMIT 5",
)
_add(
    "events_by_label",
    COUNTS,
    "SELECT event_id, coalesce(sum(n) FILTER (label = 'Normal'), 0)::BIGINT AS Normal, "
    "coalesce(sum(n) FILTER (label = 'Anomaly'), 0)::BIGINT AS Anomaly, sum(n)::BIGINT AS total "
    "FROM counts JOIN labels_of USING (entity_id) GROUP BY event_id ORDER BY total DESC, event_id LIMIT 10",
)
_add(
    "top_events_per_label",
    f"{COUNTS}, sums AS (SELECT label, event_id, sum(n)::BIGINT AS n FROM counts JOIN labels_of USING (entity_id) GROUP BY ALL)",
    "SELECT label, row_number() OVER (PARTITION BY label ORDER BY n DESC, event_id)::INT AS rank, event_id, n, "
    "round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY label), 6) AS pct FROM sums QUALIFY rank <= 3",
)
_matrix_columns = ["entity_id", *[f"E{i}" for i in range(1, 6)], "total_events", "label"]
_add(
    "missing_profile",
    COUNTS,
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, "
        f"round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS missing_pct FROM labelled_matrix"
        for c in _matrix_columns
    )
    + ") WHERE missing > 0",
)
_add(
    "column_profile",
    COUNTS,
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{'string' if c in ('entity_id', 'label') else 'bigint'}' AS type, "
        f"count({c}) AS non_null, count(*) AS rows FROM labelled_matrix"
        for c in _matrix_columns
    ),
)
_add("event_variance", QUANTITY, "SELECT event_id, event_no, round(variance, 6) AS variance FROM variances")
_add(
    "low_variance_events",
    QUANTITY,
    "SELECT event_id, event_no, round(variance, 6) AS variance FROM variances WHERE variance < 0.7",
)
_add("event_correlation", QUANTITY, "SELECT event_a, event_b, round(r, 6) AS r FROM pairs")
_add(
    "large_count_correlation",
    """cents AS (SELECT o_custkey AS entity, substr(o_orderpriority, 1, 1)::INT AS no,
  100000000000::HUGEINT + sum(round(o_totalprice * 100)::BIGINT) AS n FROM orders GROUP BY ALL),
sums AS (SELECT no, sum(n)::HUGEINT AS t, sum(n * n)::HUGEINT AS q FROM cents GROUP BY no),
size AS (SELECT count(DISTINCT entity)::HUGEINT AS m FROM cents),
crossed AS (SELECT a.no AS i, b.no AS j, sum(a.n * b.n)::HUGEINT AS xy FROM cents a JOIN cents b USING (entity) WHERE a.no < b.no GROUP BY ALL)""",
    "SELECT 'E' || i AS event_a, 'E' || j AS event_b, round((m * xy - a.t * b.t)::DOUBLE / "
    "(sqrt((m * a.q - a.t * a.t)::DOUBLE) * sqrt((m * b.q - b.t * b.t)::DOUBLE)), 6) AS r "
    "FROM crossed JOIN sums a ON a.no = i JOIN sums b ON b.no = j, size",
)
_add(
    "correlated_pairs",
    QUANTITY,
    "SELECT event_a, event_b, round(r, 6) AS r FROM pairs WHERE r > 0.9 AND r < 1 - 1e-12 "
    "UNION ALL SELECT event_b, event_a, round(r, 6) FROM pairs WHERE r > 0.9 AND r < 1 - 1e-12",
)
_add(
    "top_event_correlation",
    f"""{QUANTITY},
top AS (SELECT event_id FROM counts GROUP BY event_id ORDER BY sum(n) DESC, substr(event_id, 2)::INT LIMIT 5)""",
    "SELECT event_a, event_b, round(r, 6) AS r FROM pairs WHERE event_a IN (FROM top) AND event_b IN (FROM top)",
)

# Feature selection
_add("select_variance", QUANTITY, "SELECT event_id, event_no FROM variances WHERE variance >= 0.7")
_add(
    "select_correlation",
    f"{QUANTITY}, survivors AS (SELECT event_id, event_no FROM variances WHERE variance >= 0.01)",
    "SELECT event_id, event_no FROM survivors WHERE event_id NOT IN (SELECT event_b FROM pairs "
    "WHERE abs(r) > 0.95 AND event_a IN (SELECT event_id FROM survivors))",
)
_add(
    "feature_table",
    COUNTS,
    "SELECT entity_id, coalesce(label = 'Anomaly', false)::INT AS target, "
    + ", ".join(f"E{i} AS x{i}" for i in range(1, 6))
    + " FROM labelled_matrix",
)
ORACLES["feature_table_sparse"] = ORACLES["feature_table"]
_add(
    "cell_matrix",
    QUANTITY,
    "SELECT entity_id, "
    + " || ',' || ".join(f"coalesce(sum(n) FILTER (event_id = 'E{i}'), 0)::BIGINT" for i in (1, 2, 5, 9, 12, 77))
    + " AS cells, coalesce(sum(n) FILTER (event_id IN ('E1', 'E2', 'E5', 'E9', 'E12', 'E77')), 0)::BIGINT AS total_events "
    "FROM counts GROUP BY entity_id",
)
_add(
    "strong_correlations",
    """facts AS (
  SELECT l_orderkey AS o, l_linenumber AS l, unnest([CASE WHEN l_quantity <= 25 THEN 21 ELSE 22 END, l_linenumber + 2]) AS no FROM lineitem),
counts AS (SELECT o, l, no, count(*) AS n FROM facts GROUP BY ALL),
grid AS (
  SELECT e.o, e.l, v.no, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT o, l FROM counts) e CROSS JOIN (SELECT DISTINCT no FROM counts) v
  LEFT JOIN counts c ON c.o = e.o AND c.l = e.l AND c.no = v.no),
pairs AS (SELECT a.no AS i, b.no AS j, corr(a.n, b.n) AS r FROM grid a JOIN grid b ON a.o = b.o AND a.l = b.l AND a.no < b.no GROUP BY ALL)""",
    "SELECT 'E' || i AS event_a, 'E' || j AS event_b, round(r, 6) AS r FROM pairs WHERE abs(r) > 0.05",
)
_add(
    "feature_summary",
    COUNTS,
    "SELECT count(*) AS rows, count(*) FILTER (label IS DISTINCT FROM 'Anomaly') AS negatives, "
    "count(*) FILTER (label = 'Anomaly') AS positives FROM labelled",
)

# Modelling and evaluation
_add(
    "stratified_folds",
    f"{COUNTS}, targets AS (SELECT entity_id, coalesce(label = 'Anomaly', false)::INT AS target FROM labelled)",
    "SELECT entity_id, target, ((row_number() OVER (PARTITION BY target ORDER BY md5(entity_id || ':42'), entity_id) - 1) % 10 + 1)"
    "::INT AS fold FROM targets",
)
_add(
    "precision_recall",
    SCORES,
    "SELECT model, fold::INT AS fold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM pr",
)
_add("roc_auc", SCORES, "SELECT model, fold::INT AS fold, round(auc, 6) AS auc FROM auc")
_add(
    "roc_curve",
    f"""{SCORES},
points AS (
  SELECT model, score, sum(target)::BIGINT AS pos, (count(*) - sum(target))::BIGINT AS neg FROM scores GROUP BY ALL),
running AS (
  SELECT *, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps, sum(pos) OVER (PARTITION BY model) AS p,
    sum(neg) OVER (PARTITION BY model) AS n, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg,
    row_number() OVER w AS rn
  FROM points WINDOW w AS (PARTITION BY model ORDER BY score DESC))""",
    "SELECT model, round(score, 6) AS threshold, round(fps / n, 6) AS fpr, round(tps / p, 6) AS tpr FROM running "
    "WHERE rn = 1 OR next_pos IS NULL OR next_pos != pos OR next_neg != neg "
    "UNION ALL SELECT DISTINCT model, NULL::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM running",
)
_add("confusion_matrix", SCORES, "SELECT * REPLACE (fold::INT AS fold) FROM cells")
_add(
    "cv_summary",
    SCORES,
    "SELECT model, folds, "
    + ", ".join(
        f"round({kind}_{m}, 6) AS {kind}_{m}" for kind in ("mean", "std") for m in ("precision", "recall", "auc")
    )
    + " FROM summary",
)
_add(
    "best_model", SCORES, "SELECT model, round(mean_auc, 6) AS mean_auc FROM summary ORDER BY summary.mean_auc DESC, model LIMIT 1"
)

# Streaming
# The same lines as files of 4000, which come in the order of their names.
PARTS = f"""{BLOCK.replace("rendered AS", "whole AS")},
rendered AS (
  SELECT value, part, 'part=' || part AS source, dense_rank() OVER (ORDER BY 'part=' || part) AS source_order, LineId - part * 4000 AS LineId
  FROM (SELECT *, (LineId - 1) // 4000 AS part FROM whole))"""
_add(
    "stream_ingest",
    f"RECURSIVE {PARTS},{_parsed(BLOCK_LOG)},{SIGNED},{MINED}",
    f"SELECT LineId, {_block_fields}, BlockId, 'E' || event_no AS EventId, EventTemplate, substr(source, 6)::BIGINT AS part "
    "FROM signed JOIN chosen USING (signature) JOIN groups USING (leader_seen) JOIN texts USING (leader_seen)",
)
_add(
    "stream_counts",
    f"{BLOCK_PARSED},{SIGNED}",
    "SELECT BlockId AS entity_id, signature AS event, count(*) AS n FROM signed WHERE BlockId IS NOT NULL GROUP BY ALL",
)
