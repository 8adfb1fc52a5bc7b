"""The bound queries as plain SQL over the same tables, for checking results in another engine."""

from __future__ import annotations

from linkwright.functions import fixed_text as fixed
from linkwright.functions.text import WORD

SPACE = WORD.replace("[^", "[").removesuffix("+")
SPLIT = "1998-05-01"
DIMS = 64
TEXT_BYTES = 20_000
REQUEST_BYTES = 3_000


def text(value: str) -> str:
    """A SQL literal; line breaks are spelled out."""
    return " || chr(10) || ".join("'" + piece.replace("'", "''") + "'" for piece in value.split("\n"))


def layout(template: str, **values: str) -> str:
    """A layout as a SQL concatenation; every mark becomes the given expression."""
    pieces = []
    for i, piece in enumerate(fixed._MARK.split(template)):
        if i % 2:
            pieces.append(f"CAST({values[piece]} AS VARCHAR)")
        elif piece:
            pieces.append(text(piece))
    return " || ".join(pieces)


def placed(rows: str, keys: str, line: str, order: str, sep: int, limit: int) -> str:
    """The rows of a table with the part of the key's whole text in which the line begins."""
    return f"""(SELECT *, CAST(coalesce(sum(strlen({line}) + {sep}) OVER (
  PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {limit} AS BIGINT) AS part_no
  FROM {rows})"""


# --- the graph ----------------------------------------------------------------------------------

ISSUE_ROWS = """issue_rows AS (
  SELECT 'ISSUE-' || o_orderkey AS issue_id, 'CR-' || o_custkey AS change_id, o_orderstatus AS status,
         o_orderpriority AS team, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS created,
         'PAGE-' || l_partkey AS page_id, l_returnflag AS link_type, 'USER-' || l_suppkey AS watcher,
         l_linenumber, l_partkey, l_suppkey, concat_ws('#', l_linenumber, l_partkey, l_suppkey) AS row_no
  FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey),
issue_first AS (
  SELECT * FROM issue_rows
  QUALIFY row_number() OVER (PARTITION BY issue_id ORDER BY l_linenumber, l_partkey, l_suppkey) = 1)"""

TEAMS = """teams AS (
  SELECT DISTINCT team_name FROM (
    SELECT n_name AS team_name FROM nation UNION SELECT o_orderpriority FROM orders UNION SELECT p_brand FROM part)
  WHERE team_name IS NOT NULL)"""

VERTICES = f"""{ISSUE_ROWS}, {TEAMS},
vertices AS (
  SELECT 'TEAM-' || replace(team_name, ' ', '_') AS id, 'Team' AS label, 'team_name: ' || team_name AS props_text FROM teams
  UNION ALL
  SELECT 'CR-' || c_custkey, 'CR', concat_ws(chr(10), 'balance: ' || CAST(c_acctbal AS DECIMAL(18,2)), 'cr_title: ' || c_name,
         'segment: ' || c_mktsegment, 'team: ' || n_name)
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT issue_id, 'JIRA', concat_ws(chr(10), 'change_id: ' || change_id, 'created: ' || created, 'link_type: ' || link_type,
         'page_id: ' || page_id, 'status: ' || status, 'team: ' || team)
  FROM issue_first
  UNION ALL
  SELECT 'PAGE-' || p_partkey, 'Confluence', concat_ws(chr(10), 'doc_topic: ' || p_name, 'kind: ' || p_type,
         'price: ' || CAST(p_retailprice AS DECIMAL(18,2)), 'size: ' || p_size, 'team: ' || p_brand)
  FROM part)"""

EDGES = """edges AS (
  SELECT 'CR-' || c_custkey AS src, 'BELONGS_TO' AS label, 'TEAM-' || replace(n_name, ' ', '_') AS dst,
         'customer' AS src_table, '1' AS row_no
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL
  SELECT issue_id, 'BELONGS_TO', 'TEAM-' || replace(team, ' ', '_'), 'orders', row_no FROM issue_rows WHERE team IS NOT NULL
  UNION ALL
  SELECT 'PAGE-' || p_partkey, 'BELONGS_TO', 'TEAM-' || replace(p_brand, ' ', '_'), 'part', '1' FROM part WHERE p_brand IS NOT NULL
  UNION ALL
  SELECT issue_id, 'MENTIONS', change_id, 'orders', row_no FROM issue_rows
  WHERE change_id IN (SELECT 'CR-' || c_custkey FROM customer)
  UNION ALL
  SELECT issue_id, 'REFERS_TO', page_id, 'orders', row_no FROM issue_rows
  WHERE page_id IN (SELECT 'PAGE-' || p_partkey FROM part))"""

SIMPLE = """issues AS (
  SELECT o_orderkey, 'ISSUE-' || o_orderkey AS jira_id, CASE WHEN o_orderkey % 1000 <> 999 THEN 'CR-' || o_custkey END AS cr_id FROM orders),
pages AS (SELECT 'PAGE-' || p_partkey AS page_id, CASE WHEN p_size > 5 THEN 'CR-' || p_partkey END AS cr_id, p_type, p_name FROM part)"""

SINGLE = """single AS (
  SELECT src, label, dst, min(src_table) AS src_table, min(row_no) AS row_no FROM edges GROUP BY src, label, dst)"""


def incident(edges: str) -> str:
    return f"""incident AS (
  SELECT src AS node, 'out' AS direction, label AS edge_label, dst AS other_id, src_table, row_no FROM {edges}
  UNION ALL
  SELECT dst, 'in', label, src, src_table, row_no FROM {edges})"""


GRAPH = f"WITH {VERTICES}, {EDGES}"
SINGLE_GRAPH = f"{GRAPH}, {SINGLE}, {incident('single')}"
HOP = "direction, edge_label, other_id, v.label AS other_label"


def node_lines(extra: str, limit: int) -> str:
    """Context texts for the ids in a table ``nodes(node_id)``."""
    return f"""{extra},
lines AS (
  SELECT node_id, 0 AS below, {layout(fixed.NODE_HEADER, node="node_id")} AS line FROM nodes
  UNION ALL
  SELECT node_id, 1, {layout(fixed.NODE_LINE, edge="edge_label", kind="v.label", other="other_id")}
  FROM incident JOIN nodes ON node = node_id JOIN vertices v ON v.id = other_id),
node_context AS (
  SELECT node_id, part_no, string_agg(line, chr(10) ORDER BY below, line) AS context
  FROM {placed("lines", "node_id", "line", "below, line", 1, limit)} GROUP BY node_id, part_no)"""


def vertex_block(v: str) -> str:
    return (f"'id: ' || {v}.id || chr(10) || 'label: ' || {v}.label || chr(10) || "
            f"CASE WHEN {v}.props_text = '' THEN '' ELSE {v}.props_text || chr(10) END || {text(fixed.RECORD_END)}")


REQUESTS = """requests AS (
  SELECT 'REQ-' || s_suppkey AS request_id,
         CASE WHEN s_nationkey < 10 THEN 'ISSUE-' || s_suppkey END AS jira_id,
         CASE WHEN s_nationkey BETWEEN 8 AND 16 THEN 'CR-' || s_suppkey END AS cr_id,
         CASE WHEN s_nationkey BETWEEN 15 AND 22 THEN '#' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') END AS keyword
  FROM supplier)"""

REQUEST_CONTEXT = f"""{SINGLE_GRAPH}, {REQUESTS},
blocks AS (SELECT v.id, v.label, {vertex_block("v")} AS block FROM vertices v),
starts AS (
  SELECT request_id, b.id AS node, b.id AS seed_id, '' AS via_id, b.block AS head
  FROM requests JOIN blocks b ON b.id = jira_id
  UNION ALL
  SELECT request_id, via.id, seed.id, via.id, seed.block || via.block
  FROM requests JOIN blocks seed ON seed.id = cr_id JOIN single s ON s.dst = seed.id AND s.label = 'MENTIONS'
       JOIN blocks via ON via.id = s.src
  WHERE jira_id IS NULL
  UNION ALL
  SELECT request_id, b.id, b.id, '', b.block
  FROM requests JOIN (SELECT 'CR-' || c_custkey AS id, c_name AS title FROM customer
                      UNION ALL SELECT 'PAGE-' || p_partkey, p_name FROM part) k ON contains(k.title, keyword)
       JOIN blocks b ON b.id = k.id
  WHERE jira_id IS NULL AND cr_id IS NULL),
paths AS (
  SELECT request_id, seed_id, via_id, edge_label, direction, other_id,
         src_table, row_no, head || 'id: ' || concat_ws('/', CASE WHEN direction = 'out' THEN i.node ELSE other_id END, edge_label,
           CASE WHEN direction = 'out' THEN other_id ELSE i.node END, src_table, row_no) || chr(10)
           || 'label: ' || edge_label || chr(10) || {text(fixed.RECORD_END)} || o.block AS path_text
  FROM starts s JOIN incident i ON i.node = s.node JOIN blocks o ON o.id = i.other_id),
own AS (
  SELECT request_id, part_no, string_agg(path_text, '' ORDER BY seed_id, via_id, edge_label, direction, other_id, src_table, row_no) AS body
  FROM {placed("paths", "request_id", "path_text", "seed_id, via_id, edge_label, direction, other_id, src_table, row_no", 0, REQUEST_BYTES)}
  GROUP BY request_id, part_no),
mine AS (
  SELECT r.request_id, coalesce(part_no, 0) AS part_no, coalesce(body, '') AS context FROM requests r LEFT JOIN own o USING (request_id)
  WHERE coalesce(jira_id, cr_id, keyword) IS NOT NULL),
dump AS (
  SELECT 0 AS below, '' AS id, chr(10) || '=== Teams ===' || chr(10) AS block
  UNION ALL SELECT 1, id, block FROM blocks WHERE label = 'Team'),
section AS (
  SELECT part_no, string_agg(block, '' ORDER BY below, id) AS context
  FROM {placed("dump", "1", "block", "below, id", 0, REQUEST_BYTES)} GROUP BY part_no),
context AS (
  SELECT request_id, part_no, context FROM mine
  UNION ALL
  SELECT request_id, own_last + 1 + spot, context
  FROM (SELECT request_id, max(part_no) AS own_last FROM mine GROUP BY request_id),
       (SELECT row_number() OVER (ORDER BY part_no) - 1 AS spot, context FROM section)
  UNION ALL
  SELECT request_id, 0, {text(fixed.NO_INPUT)} FROM requests WHERE coalesce(jira_id, cr_id, keyword) IS NULL)"""


# --- vectors ------------------------------------------------------------------------------------

def mean_vectors(group: str) -> str:
    return f"""questions AS (
  SELECT query_id, list(x ORDER BY dim) AS q FROM (
    SELECT query_id, dim, avg(x) AS x FROM (
      SELECT {group} AS query_id, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS dim
      FROM embeddings) GROUP BY query_id, dim) GROUP BY query_id)"""


VECTOR_QUESTIONS = """questions AS (
  SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS q, label AS scope FROM embeddings WHERE vec_id % 50 = 0)"""


def topk(questions: str, k: int, condition: str = "true") -> str:
    return f"""{questions},
hits AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score
  FROM (SELECT query_id, vec_id AS id, round(list_cosine_similarity(q, CAST(embedding AS DOUBLE[])), 12) AS score
        FROM questions, embeddings WHERE {condition})
  QUALIFY rank <= {k})"""


SHOWN = "SELECT query_id, rank, id, round(score, 6) AS score FROM hits"

# --- changes ------------------------------------------------------------------------------------

DIFF = "WITH " + ", ".join(f"""{name} AS (
  SELECT id, question, answer FROM (
    SELECT concat_ws('/', o_custkey, o_orderpriority) AS id, o_orderdate, o_orderkey, o_orderstatus AS question,
           CAST(CAST(floor(o_totalprice / 100000) AS BIGINT) AS VARCHAR) AS answer
    FROM orders WHERE o_orderdate {test} TIMESTAMP '{SPLIT}')
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)"""
                           for name, test in (("before_rows", "<"), ("after_rows", ">="))) + """,
diff AS (
  SELECT coalesce(b.id, a.id) AS id, b.question AS old_question, a.question AS new_question,
         b.answer AS old_answer, a.answer AS new_answer,
         CASE WHEN b.id IS NULL THEN 'INSERT' WHEN a.id IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action
  FROM before_rows b FULL JOIN after_rows a ON a.id = b.id)"""


def detail_cases(row: str, group: tuple[str, str], other: str) -> str:
    columns = {"OldQuestion": "old_question", "NewQuestion": "new_question", "OldAnswer": "old_answer", "NewAnswer": "new_answer"}
    cases = []
    for action, groups in fixed.DETAILS.items():
        pieces = []
        for heading, rows in groups:
            pieces.append(text(heading + group[0]))
            pieces += [layout(row, label=text(label), value=f"coalesce({columns[field]}, 'None')") for label, field in rows]
            pieces.append(text(group[1]))
        cases.append(f"WHEN action = '{action}' THEN {' || '.join(pieces)}")
    return f"CASE {' '.join(cases)} ELSE {text(other)} END"


TABLE_MESSAGE = " || ".join([
    layout(fixed.TABLE_HEAD, action="action", id="id", time="'2024-01-15 10:30:00 UTC'", user="'auditor'"),
    detail_cases(fixed.TABLE_ROW, fixed.TABLE_GROUP, fixed.TABLE_OTHER), text(fixed.TABLE_TAIL)])
LIST_MESSAGE = " || ".join([
    layout(fixed.LIST_HEAD, action="action", id="id", time="'2024-01-15T10:30:00.5Z'", user="'auditor'"),
    detail_cases(fixed.LIST_ROW, fixed.LIST_GROUP, ""), text(fixed.LIST_TAIL)])

TASKS = """WITH tasks AS (
  SELECT 'TASK-' || o_orderkey AS task, 'CR-' || o_custkey AS cr, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS person,
         strftime(o_orderdate, '%Y-%m-%d %H:%M') AS begins, CASE WHEN o_custkey % 5 = 0 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M') END AS ends,
         'say "' || o_orderstatus || '", then' || chr(10) || 'go' AS said, o_orderkey % 7 AS n FROM orders)"""

CLASSIFIED = f"""WITH shapes AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS doc_key, l_returnflag AS label,
         l_linenumber AS n, l_orderkey,
         CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'vertex' WHEN l_returnflag = 'A' THEN 'flagged'
              WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'named' WHEN l_returnflag = 'N' THEN 'plain'
              ELSE 'broken' END AS shape,
         'O' || l_orderkey AS o, 'P' || l_partkey AS p
  FROM lineitem),
facts AS (
  SELECT doc_key, CASE shape WHEN 'broken' THEN NULL WHEN 'vertex' THEN 'vertex' ELSE 'edge' END AS kind,
         CASE WHEN shape = 'vertex' AND n = 2 THEN l_orderkey || '.0' WHEN shape <> 'broken' THEN doc_key END AS element_id,
         CASE WHEN shape = 'vertex' AND n = 1 THEN '[1, "a''s", None, 2.5, {{''k'': True}}]' WHEN shape <> 'broken' THEN label END AS label,
         CASE WHEN shape = 'flagged' THEN '{fixed.UNKNOWN["source"]}' WHEN shape IN ('named', 'plain') THEN o END AS source_id,
         CASE WHEN shape = 'flagged' THEN '{fixed.UNKNOWN["target"]}' WHEN shape IN ('named', 'plain') THEN p END AS target_id,
         CASE WHEN shape = 'named' THEN 'order' ELSE '{fixed.UNKNOWN["outVLabel"]}' END AS source_label,
         CASE WHEN shape = 'named' THEN 'part' WHEN shape = 'flagged' THEN 'None' ELSE '{fixed.UNKNOWN["inVLabel"]}' END AS target_label,
         CASE WHEN shape = 'broken' THEN 'not a JSON object' END AS error
  FROM shapes),
classified AS (
  SELECT doc_key, kind, element_id, label, source_id, target_id,
         CASE kind WHEN 'edge' THEN {layout(fixed.EDGE_SUBJECT, label="label", id="element_id")}
                   WHEN 'vertex' THEN {layout(fixed.VERTEX_SUBJECT, label="label", id="element_id")} END AS subject,
         CASE kind WHEN 'edge' THEN {layout(fixed.EDGE_MESSAGE, label="label", id="element_id", source_label="source_label",
                                            source_id="source_id", target_label="target_label", target_id="target_id")}
                   WHEN 'vertex' THEN {layout(fixed.VERTEX_MESSAGE, label="label", id="element_id")} END AS message,
         error
  FROM facts)"""


def outbox(source: str) -> str:
    quoted = "CAST(to_json(message) AS VARCHAR)"
    return f"""SELECT message_key, 'chat' AS channel, NULL AS subject, '{{"text":' || {quoted} || '}}' AS body FROM {source}
UNION ALL
SELECT message_key, 'mail', subject,
       '<strong>' || message || '</strong><p>Raw Document: <pre>' || {quoted} || '</pre></p>' FROM {source}"""


WORDS = f"list_filter(string_split_regex(text, '{SPACE}+'), lambda w: w <> '')"


def words(value: str) -> str:
    return f"len(list_filter(string_split_regex({value}, '{SPACE}+'), lambda w: w <> ''))"


def stripped(value: str) -> str:
    return f"regexp_replace({value}, '^{SPACE}+|{SPACE}+$', '', 'g')"


# The packing rule as it reads: the running text itself is the state of the fold.
CHUNKS = f"""WITH sentences AS (
  SELECT doc_id, string_split(regexp_replace(coalesce(text, ''), '([.!?]) +', concat('\\1', chr(1)), 'g'), chr(1)) AS parts
  FROM documents),
packed AS (
  SELECT doc_id, list_reduce(
    list_transform(parts, lambda s: {{'chunks': CAST([] AS VARCHAR[]), 'cur': s}}),
    lambda a, s: CASE
      WHEN {words("a.cur || s.cur")} <= 200 THEN {{'chunks': a.chunks, 'cur': a.cur || ' ' || s.cur}}
      ELSE {{'chunks': CASE WHEN a.cur <> '' THEN list_append(a.chunks, {stripped("a.cur")}) ELSE a.chunks END, 'cur': s.cur}} END,
    {{'chunks': CAST([] AS VARCHAR[]), 'cur': ''}}) AS folded
  FROM sentences),
listed AS (
  SELECT doc_id, CASE WHEN folded.cur <> '' THEN list_append(folded.chunks, {stripped("folded.cur")}) ELSE folded.chunks END AS chunks
  FROM packed)
SELECT doc_id || '_chunk_' || (i - 1) AS chunk_id, CAST(doc_id AS VARCHAR) AS node_id, 'Confluence' AS node_type,
       chunks[i] AS text, CAST(i - 1 AS BIGINT) AS ordinal
FROM (SELECT doc_id, chunks, unnest(range(1, len(chunks) + 1)) AS i FROM listed)"""

DOCUMENT_GRAPH = f"""edges AS (
  SELECT 'DOC-' || doc_id AS src, 'FROM_SOURCE' AS label, 'SOURCE-' || source AS dst, 'documents' AS src_table, '1' AS row_no
  FROM documents WHERE source IS NOT NULL
  UNION ALL SELECT 'DOC-' || doc_id, 'IN_LANGUAGE', 'LANG-' || lang, 'documents', '1' FROM documents WHERE lang IS NOT NULL
  UNION ALL SELECT 'DOC-' || vec_id, 'HAS_TOPIC', 'LABEL-' || label, 'embeddings', '1'
  FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents)),
vertices AS (
  SELECT 'DOC-' || doc_id AS id, 'Document' AS label FROM documents
  UNION SELECT 'SOURCE-' || source, 'Source' FROM documents
  UNION SELECT 'LANG-' || lang, 'Language' FROM documents
  UNION SELECT 'LABEL-' || label, 'Topic' FROM embeddings),
{incident("edges")}"""

REQUESTS = """WITH paired AS (
  SELECT v.user_id, v.event_id AS request_id, v.ts, min({'ts': c.ts, 'id': c.event_id}) AS answer
  FROM events v LEFT JOIN events c ON c.event_type = 'click' AND c.user_id = v.user_id
       AND c.ts BETWEEN v.ts AND v.ts + INTERVAL 30 MINUTE
  WHERE v.event_type = 'view' GROUP BY v.user_id, v.event_id, v.ts)
SELECT user_id, request_id, answer.id AS response_id, round(date_diff('microsecond', ts, answer.ts) / 1000000.0, 3) AS wait_seconds,
       CAST(CASE WHEN answer.id IS NULL THEN 504 ELSE 200 END AS BIGINT) AS status FROM paired"""

FIFO = """WITH turns AS (
  SELECT conv_id, turn, role = 'user' AS asks FROM conversations WHERE role IN ('user', 'assistant')),
summed AS (
  SELECT *, sum(CASE WHEN asks THEN -1 ELSE 1 END) OVER w AS s, sum(asks::INT) OVER w AS asked, sum((NOT asks)::INT) OVER w AS answered
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
spared AS (
  SELECT *, greatest(0, coalesce(max(CASE WHEN NOT asks THEN s END) OVER (PARTITION BY conv_id ORDER BY turn), 0)) AS spare FROM summed),
requests AS (SELECT conv_id, asked AS n, turn AS request FROM spared WHERE asks),
responses AS (
  SELECT conv_id, answered - spare AS n, min(turn) AS response FROM spared
  WHERE NOT asks AND answered - spare > 0 GROUP BY conv_id, answered - spare)
SELECT requests.conv_id, CAST(requests.n AS BIGINT) AS n, request, response
FROM requests LEFT JOIN responses ON requests.conv_id = responses.conv_id AND requests.n = responses.n"""

CAPTURE = """WITH steps AS (
  SELECT user_id AS id, event_id AS seq, event_type AS question, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS answer,
         event_type = 'error' AS deleted FROM events),
pairs AS (
  SELECT *, lag(question) OVER w AS q0, lag(answer) OVER w AS a0, coalesce(NOT lag(deleted) OVER w, false) AS alive
  FROM steps WINDOW w AS (PARTITION BY id ORDER BY seq))
SELECT id, seq, CASE WHEN alive THEN q0 END AS old_question, CASE WHEN NOT deleted THEN question END AS new_question,
       CASE WHEN alive THEN a0 END AS old_answer, CASE WHEN NOT deleted THEN answer END AS new_answer,
       CASE WHEN deleted THEN 'DELETE' WHEN alive THEN 'UPDATE' ELSE 'INSERT' END AS action
FROM pairs WHERE alive OR NOT deleted"""

ORACLES = {
    "vector_graph_context": f"""WITH {topk(mean_vectors("CAST(label AS BIGINT)"), 5, "vec_id IN (SELECT doc_id FROM documents)")
        .replace("vec_id AS id", "'DOC-' || vec_id AS id")}, {DOCUMENT_GRAPH},
nodes AS (SELECT DISTINCT id AS node_id FROM hits), {node_lines("dummy AS (SELECT 1)", 4_000_000)}
SELECT query_id, rank, n.node_id, round(score, 6) AS score, part_no, context,
       {layout(fixed.SHORT_PROMPT, question="'What is typical of label ' || query_id || '?'",
               context="(" + layout(fixed.HIT_BLOCK, kind="'Document'", node="n.node_id", text="coalesce(text, '')", context="context") + ")")} AS prompt
FROM hits JOIN node_context n ON n.node_id = hits.id JOIN documents ON 'DOC-' || doc_id = hits.id""",
    "left_join_chain": """SELECT c_custkey, o_orderkey, o_orderpriority, c_name, n_name
FROM (SELECT o_orderkey, o_custkey AS k, o_orderpriority FROM orders) LEFT JOIN customer ON k = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "null_safe_left_merge": """SELECT c_custkey, l.key, n_name FROM (SELECT c_custkey, nullif(c_nationkey, 0) AS key FROM customer) l
LEFT JOIN (SELECT nullif(n_nationkey, 0) AS key, n_name FROM nation) r ON l.key IS NOT DISTINCT FROM r.key""",
    "typed_cast": """SELECT c_custkey, CAST(TRY_CAST(nullif(trim(balance), '') AS DECIMAL(18,2)) AS VARCHAR) AS balance,
       TRY_CAST(nullif(trim(nation), '') AS INTEGER) AS nation
FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '  ' WHEN c_mktsegment = 'MACHINERY' THEN 'n/a'
             ELSE ' ' || CAST(c_acctbal AS DECIMAL(18,2)) END AS balance,
             CASE WHEN c_nationkey = 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS nation FROM customer)""",
    "timestamp_text": """SELECT event_id, CASE WHEN event_type IN ('view', 'click', 'purchase') THEN strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC'
       WHEN event_type = 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+05:30' ELSE 'N/A' END AS shown FROM events""",
    "first_row_per_key": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) = 1""",
    "latest_row_per_key": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(l_shipdate AS DATE) DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC) = 1""",
    "duplicate_keys": """SELECT l_orderkey, l_suppkey, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "fk_orphans": """SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "fk_stubs": """SELECT doc_id, 'labelled' AS title, quality FROM labels
UNION ALL SELECT DISTINCT doc_id, 'Placeholder for ' || doc_id, NULL FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "surrogate_keys": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS row_id FROM lineitem""",
    "normalize_entities": f"WITH {ISSUE_ROWS} SELECT issue_id, change_id, status, team, created FROM issue_first",
    "normalize_links": f"""WITH {ISSUE_ROWS} SELECT DISTINCT issue_id, page_id, link_type FROM issue_rows
WHERE page_id IS NOT NULL AND link_type IS NOT NULL""",
    "normalize_watchers": f"WITH {ISSUE_ROWS} SELECT DISTINCT issue_id, watcher FROM issue_rows WHERE watcher IS NOT NULL",
    "delimited_explode": """SELECT l_orderkey,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS ordinal,
       CAST(l_partkey AS VARCHAR) AS part FROM lineitem""",
    "team_vertices": f"WITH {TEAMS} SELECT 'TEAM-' || replace(team_name, ' ', '_') AS id, 'Team' AS label, team_name FROM teams",
    "graph_vertices": f"WITH {VERTICES} SELECT id, label, props_text FROM vertices",
    "graph_edges_multi": f"""WITH {ISSUE_ROWS}, {EDGES} SELECT src, label, dst, src_table, row_no,
CASE WHEN src LIKE 'CR-%' THEN 'CR' WHEN src LIKE 'ISSUE-%' THEN 'JIRA' ELSE 'Confluence' END AS src_label,
CASE WHEN dst LIKE 'CR-%' THEN 'CR' WHEN dst LIKE 'TEAM-%' THEN 'Team' ELSE 'Confluence' END AS dst_label FROM edges""",
    "graph_edges_distinct": f"WITH {ISSUE_ROWS}, {EDGES} SELECT DISTINCT src, label, dst FROM edges",
    "graph_counts": f"""{GRAPH} SELECT 'vertex' AS kind, label, count(*) AS n FROM vertices GROUP BY label
UNION ALL SELECT 'edge', label, count(*) FROM edges GROUP BY label""",
    "simple_graph_vertices": f"""WITH {SIMPLE} SELECT jira_id AS id, 'Jira' AS label,
       concat_ws(chr(10), 'cr_id: ' || coalesce(cr_id, ''), 'jira_summary: ' || o_orderpriority) AS props_text FROM issues JOIN orders USING (o_orderkey)
UNION ALL SELECT 'CR-' || c_custkey, 'CR', concat_ws(chr(10), 'cr_status: ' || c_mktsegment, 'cr_title: ' || c_name,
       'created_at: ' || CAST(c_acctbal AS DECIMAL(18,2)), 'team_name: None', 'updated_by_user: loader') FROM customer
UNION ALL SELECT page_id, 'Confluence', concat_ws(chr(10), 'cr_id: ' || coalesce(pages.cr_id, ''),
       'doc_content: ' || p_type, 'doc_topic: ' || p_name, 'jira_id: ' || coalesce(first_issue, ''))
FROM pages LEFT JOIN (SELECT cr_id, min(jira_id) AS first_issue FROM issues GROUP BY cr_id) f ON f.cr_id IS NOT DISTINCT FROM pages.cr_id""",
    "simple_graph_edges": f"""WITH {SIMPLE} SELECT DISTINCT page_id AS src, 'REFERS_TO' AS label, jira_id AS dst,
       'Confluence' AS src_label, 'Jira' AS dst_label FROM pages JOIN issues ON issues.cr_id IS NOT DISTINCT FROM pages.cr_id
UNION ALL SELECT DISTINCT jira_id, 'MENTIONS', cr_id, 'Jira', 'CR' FROM issues
WHERE cr_id IN (SELECT 'CR-' || c_custkey FROM customer)""",
    "simple_graph_edges_strict": """SELECT DISTINCT 'PAGE-' || p_partkey AS src, 'REFERS_TO' AS label, 'ISSUE-' || o_orderkey AS dst
FROM part JOIN orders ON o_custkey = p_partkey WHERE p_size > 5 AND o_orderkey % 1000 <> 999
UNION ALL SELECT DISTINCT 'ISSUE-' || o_orderkey, 'MENTIONS', 'CR-' || o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer) AND o_orderkey % 1000 <> 999""",
    "full_graph_vertices": f"""WITH {TEAMS}
SELECT 'TEAM-' || replace(team_name, ' ', '_') AS id, 'Team' AS label, 'team_name: ' || team_name AS props_text FROM teams
UNION ALL SELECT 'CR-' || c_custkey, 'CR', concat_ws(chr(10), 'CR_ID: CR-' || c_custkey, 'CR_Team_Assignment_Group: ' || n_name,
       'Linked_Confluence_ID: PAGE-' || c_custkey, 'Linked_Jira_ID: ISSUE-' || c_custkey)
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'ISSUE-' || o_orderkey, 'JIRA', concat_ws(chr(10), 'CR_ID_Link_From_CSV_Example: CR-' || o_custkey, 'JIRA_ID: ISSUE-' || o_orderkey,
       'JIRA_Link_Type: ' || CASE o_orderstatus WHEN 'F' THEN 'blocks' WHEN 'O' THEN 'relates to' END,
       'JIRA_Linked_Issue_ID_Target: ISSUE-' || o_custkey, 'JIRA_Team: ' || o_orderpriority) FROM orders
UNION ALL SELECT 'PAGE-' || p_partkey, 'Confluence', concat_ws(chr(10), 'Confluence_ID: PAGE-' || p_partkey,
       'Confluence_Linked_CR_ID: ' || CASE WHEN p_size > 5 THEN 'CR-' || p_partkey END,
       'Confluence_Linked_Jira_ID: ISSUE-' || p_partkey || ';;ISSUE-' || (p_partkey + 1) || ';ISSUE-x;',
       'Confluence_Team_Association: ' || p_brand) FROM part""",
    "full_graph_edges": """WITH links AS (
  SELECT 'CR-' || c_custkey AS src, 'REFERS_TO' AS label, 'ISSUE-' || c_custkey AS dst, 'CR' AS src_label, 'CR_Main' AS src_table FROM customer
  UNION ALL SELECT 'CR-' || c_custkey, 'REFERS_TO', 'PAGE-' || c_custkey, 'CR', 'CR_Main' FROM customer
  UNION ALL SELECT 'ISSUE-' || o_orderkey, 'MENTIONS', 'CR-' || o_custkey, 'JIRA', 'JIRA_Issues_Detailed' FROM orders
  UNION ALL SELECT 'ISSUE-' || o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'blocks' ELSE 'relates to' END, 'ISSUE-' || o_custkey, 'JIRA', 'JIRA_Issues_Detailed'
    FROM orders WHERE o_orderstatus IN ('F', 'O')
  UNION ALL SELECT 'PAGE-' || p_partkey, 'REFERS_TO', 'ISSUE-' || (p_partkey + i), 'Confluence', 'Confluence_Pages_Detailed' FROM part, (VALUES (0), (1)) v(i)
  UNION ALL SELECT 'PAGE-' || p_partkey, 'REFERS_TO', 'CR-' || p_partkey, 'Confluence', 'Confluence_Pages_Detailed' FROM part WHERE p_size > 5),
targets AS (
  SELECT 'CR-' || c_custkey AS id, 'CR' AS dst_label FROM customer UNION ALL SELECT 'ISSUE-' || o_orderkey, 'JIRA' FROM orders
  UNION ALL SELECT 'PAGE-' || p_partkey, 'Confluence' FROM part)
SELECT src, label, dst, src_label, dst_label, src_table FROM links JOIN targets ON id = dst
UNION ALL SELECT 'CR-' || c_custkey, 'BELONGS_TO', 'TEAM-' || replace(n_name, ' ', '_'), 'CR', 'Team', 'CR_Main' FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'ISSUE-' || o_orderkey, 'BELONGS_TO', 'TEAM-' || replace(o_orderpriority, ' ', '_'), 'JIRA', 'Team', 'JIRA_Issues_Detailed' FROM orders
UNION ALL SELECT 'PAGE-' || p_partkey, 'BELONGS_TO', 'TEAM-' || replace(p_brand, ' ', '_'), 'Confluence', 'Team', 'Confluence_Pages_Detailed' FROM part""",
    "vertex_insert_if_absent": """SELECT 'DOC-' || key AS id, source, lang FROM (
  SELECT doc_id AS key, source, lang FROM documents UNION ALL SELECT vec_id, 'zz', 'zz' FROM embeddings)
WHERE key NOT IN (SELECT doc_id FROM labels) QUALIFY row_number() OVER (PARTITION BY key ORDER BY source, lang) = 1""",
    "edge_insert_if_absent": """SELECT DISTINCT 'ISSUE-' || l_orderkey AS src, 'REFERS_TO' AS label, 'PAGE-' || l_partkey AS dst
FROM lineitem l JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'
AND NOT EXISTS (SELECT 1 FROM lineitem o WHERE o.l_orderkey = l.l_orderkey AND o.l_partkey = l.l_partkey AND o.l_returnflag <> 'R')""",
    "neighborhood": f"""{GRAPH}, {incident("edges")} SELECT node AS seed_id, {HOP}
FROM incident JOIN (SELECT 'CR-' || c_custkey AS seed FROM customer) ON node = seed JOIN vertices v ON v.id = other_id""",
    "two_hop_mentions": f"""{SINGLE_GRAPH} SELECT s.src AS via_id, s.dst AS seed_id, {HOP}
FROM single s JOIN (SELECT 'CR-' || c_custkey AS seed FROM customer) ON s.dst = seed AND s.label = 'MENTIONS'
JOIN incident i ON i.node = s.src JOIN vertices v ON v.id = other_id""",
    "keyword_neighborhood": f"""{SINGLE_GRAPH} SELECT node AS seed_id, {HOP} FROM incident
JOIN (SELECT 'PAGE-' || p_partkey AS seed FROM part WHERE contains(p_name, 'ring')
      UNION ALL SELECT 'CR-' || c_custkey FROM customer WHERE contains(c_name, 'ring')) ON node = seed
JOIN vertices v ON v.id = other_id""",
    "keyword_index": """WITH keywords AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS keyword FROM part
UNION SELECT '#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') FROM customer),
texts AS (SELECT 'PAGE-' || p_partkey AS id, p_name AS t FROM part UNION ALL SELECT 'CR-' || c_custkey, c_name FROM customer)
SELECT keyword, id FROM keywords JOIN texts ON contains(t, keyword) WHERE keyword <> ''""",
    "node_context_text": f"""{GRAPH}, {incident("edges")}, nodes AS (SELECT id AS node_id FROM vertices),
{node_lines("dummy AS (SELECT 1)", TEXT_BYTES)} SELECT node_id, part_no, context FROM node_context""",
    "graph_context": f"{REQUEST_CONTEXT} SELECT request_id, part_no, context FROM context",
    "global_context": f"""WITH {VERTICES},
sections AS (SELECT * FROM (VALUES {", ".join(f"(CAST({i} AS BIGINT), {text(h)}, '{label}')"
                                              for i, (h, label) in enumerate(fixed.GLOBAL_SECTIONS))}) s(section_no, heading, label)),
lines AS (
  SELECT section_no, 0 AS below, '' AS id, heading AS block FROM sections
  UNION ALL SELECT section_no, 1, v.id, {vertex_block("v")} FROM vertices v JOIN sections USING (label))
SELECT section_no, part_no, string_agg(block, '' ORDER BY below, id) AS text
FROM {placed("lines", "section_no", "block", "below, id", 0, TEXT_BYTES)} GROUP BY section_no, part_no""",
    "request_answers": f"""{REQUEST_CONTEXT},
asked AS (SELECT request_id, part_no, context, {layout(fixed.SERVICE_QUESTION, subject="coalesce(jira_id, cr_id, keyword, 'None')")} AS question
          FROM context JOIN requests USING (request_id)),
answers AS (
  SELECT request_id, question, count(*) AS n_parts, string_agg('Reply ' || md5({layout(
      fixed.SERVICE_PROMPT, context="context", question="question")}), chr(10) || chr(10) ORDER BY part_no) AS answer
  FROM asked GROUP BY request_id, question)
SELECT request_id, n_parts, CASE WHEN n_parts = 1 THEN answer ELSE 'Reply ' || md5({layout(
    fixed.SERVICE_PROMPT, context="answer", question="question")}) END AS answer FROM answers""",
    "row_flatten": " UNION ALL ".join(
        f"""SELECT sha256(concat_ws('|', '{kind}', {key}, flat)) AS chunk_id, CAST({key} AS VARCHAR) AS node_id,
'{kind}' AS node_type, flat AS text FROM (SELECT {key}, concat_ws(' | ', {", ".join(f"'{c}: ' || " + (f"CAST({c} AS DECIMAL(18,2))" if c.endswith(("bal", "price")) else c) for c in columns)}) AS flat FROM {name})"""
        for name, kind, key, columns in [
            ("customer", "CR", "c_custkey", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment", "c_acctbal"]),
            ("part", "CONFLUENCE", "p_partkey", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]),
            ("supplier", "CTASK", "s_suppkey", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])]),
    "chunk_text": CHUNKS,
    "hashed_embedding": f"""WITH tokens AS (SELECT doc_id, md5(unnest({WORDS})) AS h FROM documents),
places AS (
  SELECT doc_id, ('0x' || substr(h, 1, 8))::BIGINT % {DIMS} AS dim,
         sum(CASE WHEN ('0x' || substr(h, 9, 2))::BIGINT % 2 = 0 THEN 1 ELSE -1 END) AS w FROM tokens GROUP BY ALL)
SELECT doc_id, dim, round(CAST(CAST(w / norm AS FLOAT) AS DOUBLE), 5) AS weight
FROM (SELECT *, sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS norm FROM places) WHERE w <> 0""",
    "model_column": f"""SELECT doc_id, 'Reply ' || md5({layout(fixed.SUMMARY_PROMPT, topic="coalesce(text, 'None')")}) AS doc_content FROM documents""",
    "cosine_topk": f"WITH {topk(mean_vectors('CAST(0 AS BIGINT)'), 5)} {SHOWN}",
    "cosine_topk_batch": f"WITH {topk(VECTOR_QUESTIONS, 10)} {SHOWN}",
    "cosine_topk_filtered": f"WITH {topk(VECTOR_QUESTIONS, 5, 'label = scope')} {SHOWN}",
    "ann_topk": f"WITH {topk(VECTOR_QUESTIONS, 5)} {SHOWN}",
    "ann_topk_filtered": f"WITH {topk(VECTOR_QUESTIONS, 5, 'label = scope')} {SHOWN}",
    "question_graph_context": f"""WITH chunks AS ({CHUNKS}),
tokens AS (
  SELECT 'chunk' AS side, chunk_id AS id, md5(unnest({WORDS})) AS h FROM chunks
  UNION ALL SELECT 'question', CAST(item_id AS VARCHAR), md5(unnest({WORDS})) FROM benchmark),
places AS (
  SELECT side, id, ('0x' || substr(h, 1, 8))::BIGINT % {DIMS} AS dim,
         sum(CASE WHEN ('0x' || substr(h, 9, 2))::BIGINT % 2 = 0 THEN 1 ELSE -1 END) AS w FROM tokens GROUP BY ALL),
weights AS (
  SELECT side, id, dim, CAST(CAST(w / nullif(sqrt(sum(w * w) OVER (PARTITION BY side, id)), 0) AS FLOAT) AS DOUBLE) AS w FROM places),
sizes AS (SELECT side, id, sqrt(sum(w * w)) AS size FROM weights GROUP BY side, id HAVING sum(w * w) > 0),
dots AS (SELECT q.id AS q, c.id AS c, sum(q.w * c.w) AS dot FROM weights q JOIN weights c ON q.dim = c.dim
         WHERE q.side = 'question' AND c.side = 'chunk' GROUP BY ALL),
hits AS (
  SELECT q.id AS query_id, c.id AS chunk_id, round(coalesce(dot, 0) / (q.size * c.size), 12) AS score,
         row_number() OVER (PARTITION BY q.id ORDER BY round(coalesce(dot, 0) / (q.size * c.size), 12) DESC, c.id) AS rank
  FROM sizes q JOIN sizes c ON q.side = 'question' AND c.side = 'chunk' LEFT JOIN dots ON dots.q = q.id AND dots.c = c.id
  QUALIFY rank <= 3),
found AS (
  SELECT CAST(query_id AS BIGINT) AS query_id, rank, chunk_id, score, 'DOC-' || c.node_id AS node_id, c.text, b.text AS question
  FROM hits JOIN chunks c USING (chunk_id) JOIN benchmark b ON CAST(item_id AS VARCHAR) = query_id),
{DOCUMENT_GRAPH}, nodes AS (SELECT DISTINCT node_id FROM found), {node_lines("dummy AS (SELECT 1)", 4_000_000)}
SELECT query_id, rank, chunk_id, round(score, 6) AS score, left(coalesce(text, ''), 300) || '...' AS preview,
       'node_id: ' || node_id || chr(10) || 'node_type: Confluence' AS metadata, part_no,
       md5({layout(fixed.SHORT_PROMPT, question="question",
                   context="(" + layout(fixed.HIT_BLOCK, kind="'Confluence'", node="node_id", text="coalesce(text, '')", context="context") + ")")}) AS prompt_md5
FROM found JOIN node_context USING (node_id)""",
    "index_upsert": """SELECT 'DOC-' || d.doc_id AS chunk_id, CASE WHEN l.doc_id IS NULL THEN d.text WHEN toxic = 1 THEN 'toxic'
       ELSE 'quality ' || quality END AS text FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "snapshot_diff": f"{DIFF} SELECT * FROM diff",
    "snapshot_diff_changed": f"""{DIFF} SELECT * FROM diff WHERE action <> 'UPDATE'
OR coalesce(old_question, '') <> coalesce(new_question, '') OR coalesce(old_answer, '') <> coalesce(new_answer, '')""",
    "pending_batch": f"{DIFF} SELECT id, action FROM diff WHERE action <> 'DELETE' ORDER BY id LIMIT 20",
    "second_batch": f"{DIFF} SELECT id, action FROM diff WHERE action <> 'DELETE' ORDER BY id LIMIT 20 OFFSET 20",
    "json_messages": f"""{DIFF} SELECT id, {TABLE_MESSAGE.replace("'None'", "'N/A'")} AS message FROM diff""",
    "audit_feed_outbox": f"""{DIFF} SELECT id AS message_key, 'mail' AS channel,
{layout(fixed.AUDIT_SUBJECT, action="action", id="id")} AS subject, {TABLE_MESSAGE} AS body FROM diff WHERE action <> 'DELETE'""",
    "csv_round_trip": f"{TASKS} SELECT task AS CTASK_ID, cr AS CR_ID, person AS CTASK_Assigned_To_User, begins AS CTASK_Start_Time, ends AS CTASK_End_Time, "
                      "said AS CTASK_Description FROM tasks WHERE n NOT IN (3, 5)",
    "csv_quarantine": f"""{TASKS} SELECT CASE n WHEN 3 THEN concat_ws(',', task, cr, coalesce(person, ''), begins)
       ELSE concat_ws(',', task, cr, coalesce(person, ''), begins, ends, 'a', 'b') END AS line FROM tasks WHERE n IN (3, 5)""",
    "csv_parallel_scan": f"{TASKS} SELECT task AS CTASK_ID, cr AS CR_ID, person AS CTASK_Assigned_To_User, begins AS CTASK_Start_Time, ends AS CTASK_End_Time, "
                      "said AS CTASK_Description FROM tasks WHERE n NOT IN (3, 5)",
    "csv_parallel_quarantine": f"""{TASKS} SELECT CASE n WHEN 3 THEN concat_ws(',', task, cr, coalesce(person, ''), begins)
       ELSE concat_ws(',', task, cr, coalesce(person, ''), begins, ends, 'a', 'b') END AS line FROM tasks WHERE n IN (3, 5)""",
    "typed_load": f"""{TASKS} SELECT task AS CTASK_ID_Source, cr AS CR_ID, begins || ':00' AS start_time,
       CASE WHEN ends <> 'soon' THEN ends || ':00' END AS end_time FROM tasks WHERE n NOT IN (3, 5)""",
    "mark_notified": f"{DIFF} SELECT id, action, action <> 'UPDATE' AS is_notified FROM diff",
    "notification_html": f"""{DIFF} SELECT id, {layout(fixed.AUDIT_SUBJECT, action="action", id="id")} AS subject,
{TABLE_MESSAGE} AS generated_email_body FROM diff""",
    "notification_list": f"{DIFF} SELECT id, {LIST_MESSAGE} AS generated_email_body FROM diff",
    "classify_changes": f"{CLASSIFIED} SELECT * FROM classified",
    "change_outbox": f"""{CLASSIFIED}, good AS (SELECT doc_key AS message_key, subject, message FROM classified WHERE error IS NULL)
{outbox("good")}""",
    "request_response": REQUESTS,
    "stream_request_response": REQUESTS,
    "fifo_pairing": FIFO,
    "stream_fifo_pairing": FIFO,
    "index_feed": """SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
    "change_feed_dead_letters": "SELECT event_id, '[]' AS document, 'not a JSON object' AS error FROM events WHERE event_type = 'error'",
    "index_insert_only": "SELECT 'DOC-' || doc_id AS chunk_id, text FROM documents",
    "running_counts": """WITH placed AS (
  SELECT user_id, event_id, event_type, (event_id - low) * 3 // (high - low + 1) AS third
  FROM events, (SELECT min(event_id) AS low, max(event_id) AS high FROM events)),
last AS (SELECT k.third, event_type FROM placed p JOIN (SELECT unnest(range(3)) AS third) k ON p.third <= k.third
  QUALIFY row_number() OVER (PARTITION BY k.third, user_id ORDER BY event_id DESC) = 1)
SELECT third, 'vertex' AS kind, event_type AS label, count(*) AS n FROM last WHERE event_type <> 'error' GROUP BY ALL""",
    "change_feed": "SELECT event_id, user_id, event_type, value FROM events",
    "change_feed_outbox": f"""WITH good AS (
  SELECT CAST(event_id AS VARCHAR) AS message_key, {layout(fixed.VERTEX_SUBJECT, label="event_type", id="event_id")} AS subject,
         {layout(fixed.VERTEX_MESSAGE, label="event_type", id="event_id")} AS message FROM events WHERE event_type <> 'error')
{outbox("good")}""",
    "change_capture": CAPTURE,
}

#: Other ways to the same rows.
ORACLES |= {
    "feed_to_outbox": ORACLES["change_outbox"],
    "snapshot_diff_checksums": ORACLES["snapshot_diff_changed"],
    "two_hop_bucketed": ORACLES["two_hop_mentions"],
}
