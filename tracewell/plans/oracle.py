"""The same answers as SQL over the sample tables, for the registered queries."""

from __future__ import annotations

from tracewell.plans.sample_tables import ODD_EXPORTS, SECRET

ORACLE: dict[str, str] = {}


def _hmac(value: str) -> str:
    """HMAC-SHA256 of a text expression under the sample key."""
    key = SECRET.encode().ljust(64, b"\0")
    inner, outer = bytes(b ^ 0x36 for b in key).hex(), bytes(b ^ 0x5C for b in key).hex()
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({value}))))"


def _sql(name: str, text: str, *parts: str) -> None:
    ORACLE[name] = (f"WITH {', '.join(parts)} " if parts else "") + text


K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
IP = "'10.0.' || (user_id // 256) || '.' || (user_id % 256)"
CALLS = f"""calls AS (
  SELECT event_id, ts, CASE WHEN event_type IN ('view', 'click') THEN 'llm' ELSE 'mcp' END AS kind,
    'user-' || user_id AS user_id, 'session-' || user_id AS session_id, 'server-' || (user_id % 7) AS mcp_server,
    event_type AS handler_name, 'mcp://server-' || (user_id % 7) || '/' || event_type AS endpoint,
    'mcp_' || event_type AS method, CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status,
    value AS duration_ms, CAST(floor(value) AS BIGINT) AS tokens_total, 'provider-' || (user_id % 3) AS provider,
    'model-' || ({K} % 5) AS model, {K} AS k
  FROM events)"""
PATH = "regexp_extract(url, '^[a-z]+://[^/]+(/.*)$', 1)"
REQUESTS = f"""requests AS (
  SELECT page_id, {PATH} AS path, string_split({PATH}, '?')[1] AS endpoint,
    regexp_extract(url, '^([a-z]+)://', 1) AS scheme, length(html) AS size,
    CASE WHEN contains({PATH}, '?') THEN substr({PATH}, instr({PATH}, '?') + 1) END AS query,
    epoch_us(TIMESTAMP '2024-01-01') + page_id * 60000000 AS ts_us,
    CASE WHEN page_id % 2 = 0 THEN 'POST' ELSE 'GET' END AS method
  FROM pages)"""
PARAMS = """params AS (
  SELECT page_id, endpoint, string_split(p, '=')[1] AS name,
    CASE WHEN contains(p, '=') THEN url_decode(replace(substr(p, instr(p, '=') + 1), '+', ' ')) ELSE '' END AS value
  FROM (SELECT page_id, endpoint, unnest(string_split(query, '&')) AS p FROM requests) WHERE p <> '')"""
KEPT = "kept AS (SELECT * FROM requests WHERE NOT starts_with(endpoint, '/de/'))"
BODY = "method = 'POST' AND page_id % 3 = 0"

_sql("http_inventory", """
  SELECT 'http' AS kind, endpoint, method, count(*) AS calls, count(*) FILTER (page_id % 9 = 0) AS errors, min(ts_us) AS first_us,
    max(ts_us) AS last_us, round(quantile_cont((page_id % 40 + 0.5)::DOUBLE, 0.95), 6) AS p95_duration_ms
  FROM kept GROUP BY endpoint, method""", REQUESTS, KEPT)
_sql("http_event_fields", f"""
  SELECT page_id, ts_us, {_hmac("'10.1.0.' || (page_id % 250)")} AS remote_addr, endpoint, scheme, method,
    'agent/' || (page_id % 5) AS user_agent, 'user-' || (page_id % 17) AS user_id,
    {_hmac("'Bearer t' || (page_id % 11)")} AS h_authorization, '[REDACTED]' AS h_cookie, 'a/b, c/d' AS h_accept,
    7::BIGINT AS n_headers,
    (SELECT string_agg(value, ',') FROM params p WHERE p.page_id = k.page_id AND name = 'page') AS q_page,
    (SELECT max('[REDACTED]') FROM params p WHERE p.page_id = k.page_id AND name = 'ref') AS q_ref,
    CASE WHEN {BODY} AND page_id % 4 <> 0 THEN CAST(size AS VARCHAR) END AS b_size,
    CASE WHEN {BODY} AND page_id % 4 <> 0 THEN '[REDACTED]' END AS b_password,
    CASE WHEN {BODY} AND page_id % 4 <> 0 THEN '[REDACTED]' END AS b_key,
    CASE WHEN {BODY} AND page_id % 4 <> 0 THEN CAST(page_id AS VARCHAR) END AS b_page,
    CASE WHEN {BODY} AND page_id % 4 = 0 THEN 'm' END AS b_model
  FROM kept k""", REQUESTS, KEPT, PARAMS)
_sql("parse_query", """
  SELECT r.page_id, r.endpoint, p.name, CASE WHEN p.name = 'ref' THEN '[REDACTED]' ELSE string_agg(p.value, ',') END AS value
  FROM requests r LEFT JOIN params p USING (page_id) GROUP BY r.page_id, r.endpoint, p.name""", REQUESTS, PARAMS)
_sql("build_headers", f"""
  SELECT page_id, 'Accept' AS name, 'a/b, c/d' AS value FROM pages
  UNION ALL SELECT page_id, 'Authorization', {_hmac("'Bearer t' || (page_id % 11)")} FROM pages
  UNION ALL SELECT page_id, 'Cookie', '[REDACTED]' FROM pages""")
_sql("filter_headers", """
  SELECT page_id, 'User-Agent' AS name, 'agent/' || (page_id % 5) AS value FROM pages
  UNION ALL SELECT page_id, 'X-User', 'user-' || (page_id % 17) FROM pages""")
_sql("resolve_client_ip", """
  SELECT page_id, '10.1.0.' || (page_id % 250) AS gateway_ip, '192.168.0.9' AS fallback_ip,
    '10.1.0.' || (page_id % 250) || ':443' AS span_ip FROM pages""")
_sql("drop_health_exact", "SELECT page_id, endpoint FROM requests WHERE length(endpoint) % 2 <> 0", REQUESTS)
_sql("split_health_segment", """
  SELECT endpoint, CASE WHEN NOT starts_with(endpoint, 'mcp') AND (endpoint LIKE '%/Healthz/' OR endpoint LIKE '%/live')
    THEN 'skipped' ELSE 'accepted' END AS ingest, count(*) AS n
  FROM (SELECT CASE WHEN k % 3 = 0 THEN 'mcp://s' ELSE '/api' END ||
    CASE k % 4 WHEN 0 THEN '/Healthz/' WHEN 1 THEN '/live' ELSE '/x' END AS endpoint FROM calls) GROUP BY 1, 2""", CALLS)
_sql("filter_paths", """
  SELECT page_id, endpoint FROM requests
  WHERE (regexp_matches(endpoint, '^/en/[^/]*$') OR starts_with(endpoint, '/fr/') OR starts_with(endpoint, '/de/'))
    AND NOT endpoint LIKE '%.html' AND NOT regexp_matches(endpoint, '^/fr/1[^/]*$')""", REQUESTS)
_sql("sample_requests", """
  SELECT event_id FROM events
  WHERE ('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::UBIGINT / 4294967296.0 < 0.25""")
_sql("body_eligible", """
  SELECT page_id, method = 'POST' AND page_id % 3 = 0 AND page_id % 10 NOT IN (0, 6) AS captured,
    CASE WHEN method = 'POST' AND page_id % 3 = 0 AND page_id % 10 NOT IN (0, 6) AND page_id % 4 <> 0
      THEN CAST(size AS VARCHAR) END AS b_size FROM requests""", REQUESTS)
_sql("response_body_eligible", """
  SELECT page_id, CASE WHEN page_id % 7 <> 0 AND page_id % 5 > 0 THEN CAST(page_id AS VARCHAR) END AS r_id,
    CASE WHEN page_id % 7 = 0 THEN 'gzip' END AS skipped FROM pages""")
_sql("split_metrics", """
  SELECT page_id, CASE WHEN method = 'POST' THEN 'post' ELSE 'GET' END AS m, '[REDACTED]' AS token,
    CAST(page_id AS VARCHAR) AS r_id, NULL::VARCHAR AS left_over FROM requests""", REQUESTS)
SHAPED = f"""shaped AS (SELECT event_id,
    CASE {K} % 6 WHEN 0 THEN '/v1/chat/completions' WHEN 1 THEN '/model/x/invoke' ELSE '/api/orders' END AS endpoint,
    {K} % 6 < 2 AS on_path, {K} % 5 = 0 AS jsonrpc, {K} % 5 IN (1, 2, 3) AS shape FROM events)"""
_sql("withhold_ai_bodies", "SELECT event_id, NOT (on_path OR (shape AND NOT jsonrpc)) AS kept FROM shaped", SHAPED)
_sql("ai_traffic_report", """
  SELECT endpoint, CASE WHEN jsonrpc THEN 'jsonrpc' WHEN on_path THEN 'path' WHEN shape THEN 'shape' ELSE 'none' END AS verdict,
    count(*) AS requests FROM shaped GROUP BY 1, 2""", SHAPED)

_sql("pseudonymize", f"SELECT c_custkey, {_hmac('c_name')} AS c_name, {_hmac('c_mktsegment')} AS segment FROM customer")
_sql("normalize_ip_column", f"SELECT event_id, {IP} AS ip FROM events")
EMAIL = "(?i)[a-z0-9._%+-]+@[a-z0-9.-]+\\.[a-z]{2,}"
IPV4 = "[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}"
CARD = "[0-9]{13,16}"
_sql("scrub_pii", f"""
  SELECT doc_id, md5(t) AS text_md5, length(t)::BIGINT AS n_chars FROM (
    SELECT doc_id, regexp_replace(regexp_replace(hashed, '{IPV4}', '[REDACTED]', 'g'), '{CARD}', '[REDACTED]', 'g') AS t
    FROM (SELECT doc_id, CASE WHEN len(mails) = 0 THEN text ELSE list_reduce(
        list_prepend(text, mails), lambda acc, m: replace(acc, m, {_hmac('m')})) END AS hashed
      FROM (SELECT doc_id, text, list_reverse_sort(list_distinct(regexp_extract_all(text, '{EMAIL}'))) AS mails FROM documents)))""")
_sql("scrub_map_keys", f"""
  SELECT event_id, 'account_ref' AS name, {_hmac('CAST(user_id AS VARCHAR)')} AS value FROM events
  UNION ALL SELECT event_id, 'Token', '[REDACTED]' FROM events
  UNION ALL SELECT event_id, 'note', 'from [REDACTED]' FROM events""")
_sql("pii_hit_report", " UNION ALL ".join(f"""
  SELECT source, '{label}' AS rule, 'text' AS source_column, count(*) AS docs, sum(h)::BIGINT AS hits
  FROM (SELECT source, len(regexp_extract_all(text, '{pattern}')) AS h FROM documents) WHERE h > 0 GROUP BY source"""
    for label, pattern in (("email", EMAIL), ("ipv4", IPV4), ("card", CARD))))
_sql("truncate_strings", """
  SELECT doc_id, md5(CASE WHEN length(text) > 256 THEN left(text, 256) || '...[TRUNCATED]' ELSE text END) AS text_md5
  FROM documents""")
_sql("redact_json", """
  SELECT doc_id, md5(CASE WHEN length(text) > 500 THEN left(text, 500) || '...[TRUNCATED]' ELSE text END) AS text_md5,
    '[REDACTED]' AS api_key, '[REDACTED]' AS lang, '[REDACTED]' AS cvv FROM documents""")
_sql("redact_struct", "SELECT doc_id, '[REDACTED]' AS token, lang, NULL::BIGINT AS ssn, n_chars FROM documents")
REDACTED_BODY = """bodies AS (SELECT doc_id, strlen(CAST(json_object('Api_Key', '[REDACTED]', 'meta',
    json_object('CVV', '[REDACTED]', 'lang', lang), 'text', text) AS VARCHAR)) AS total FROM documents)"""
_sql("head_tail_body", """
  SELECT doc_id, CASE WHEN total > 500 THEN 'true' ELSE 'false' END AS truncated, CASE WHEN total > 500 THEN total END AS total,
    CASE WHEN total > 500 THEN total - 500 END AS dropped FROM bodies""", REDACTED_BODY)
_sql("fit_encoded", """
  SELECT doc_id, md5(CASE WHEN total + 2 <= 300 THEN text ELSE left(text, kept) || '...[TRUNCATED]' END) AS text_md5 FROM (
    SELECT doc_id, any_value(text) AS text, max(used) AS total, coalesce(max(i) FILTER (used <= 282), 0)::BIGINT AS kept
    FROM sizes GROUP BY doc_id)""", """chars AS (SELECT doc_id, text, i, substr(text, i, 1) AS c
    FROM documents, range(1, 302) r(i) WHERE i <= length(text)),
  sizes AS (SELECT doc_id, text, i, sum(CASE WHEN c IN ('"', chr(92), chr(8), chr(9), chr(10), chr(12), chr(13)) THEN 2
      WHEN unicode(c) BETWEEN 32 AND 126 THEN 1 WHEN unicode(c) < 65536 THEN 6 ELSE 12 END)
    OVER (PARTITION BY doc_id ORDER BY i) AS used FROM chars)""")
_sql("sanitize_mcp_arguments", f"""
  SELECT event_id, CAST({K} AS VARCHAR) AS item, '[REDACTED]' AS token,
    CASE WHEN {K} * 4 > 200 THEN repeat('x', 200) || '... (' || ({K} * 4) || ' chars)' ELSE repeat('x', {K} * 4) END AS note,
    '[REDACTED]' AS password, event_type AS kind FROM events""")
SUMMARY = f"""CASE {K} % 5 WHEN 0 THEN 'dict(keys=2)' WHEN 1 THEN 'list(len=3)' WHEN 2 THEN 'str(len=' || length(event_type) || ')'
    WHEN 3 THEN CAST({K} AS VARCHAR) ELSE 'None' END"""
_sql("summarize_result", f"SELECT event_id, {SUMMARY} AS result_summary FROM events")
# Sizes of the rendered event and of its shed forms.
SIZED = """parts AS (
    SELECT doc_id, source, lang, text AS body, text AS extra FROM documents),
  sizes AS (
    SELECT doc_id, source,
      strlen('{"remote_addr":null,"endpoint":"/d","scheme":"http","method":"POST","timestamp":"2024-01-01T00:00:00.000000+00:00","custom_data":,"headers":null,"query_params":null,"body":,"user_agent":null,"user_id":null}') AS base,
      strlen(CAST(json_object('extra', extra, 'lang', lang) AS VARCHAR)) AS custom,
      strlen(CAST(json_object('text', body) AS VARCHAR)) AS body,
      strlen(CAST(json_object('content_dropped_oversize', true, 'extra', extra, 'lang', lang) AS VARCHAR)) AS slim,
      strlen(CAST(json_object('content_dropped_oversize', true, 'extras_dropped_oversize', true, 'lang', lang) AS VARCHAR)) AS bare
    FROM parts),
  sized AS (
    SELECT doc_id, source,
      CASE WHEN base + custom + body <= 1800 THEN 'fits' WHEN base + 4 + slim <= 1800 THEN 'content_dropped'
        WHEN base + 4 + bare <= 1800 THEN 'extras_dropped' ELSE 'dropped' END AS size_action,
      CASE WHEN base + custom + body <= 1800 THEN base + custom + body WHEN base + 4 + slim <= 1800 THEN base + 4 + slim
        ELSE base + 4 + bare END AS event_bytes
    FROM sizes)"""
_sql("enforce_event_size_by_document", "SELECT doc_id, size_action, event_bytes FROM sized", SIZED)
_sql("payload_size_report", """
  SELECT source, size_action, count(*) AS events, sum(event_bytes)::BIGINT AS total_bytes,
    round(quantile_cont(event_bytes, 0.5), 6) AS p50_bytes, round(quantile_cont(event_bytes, 0.95), 6) AS p95_bytes,
    max(event_bytes) AS max_bytes FROM sized GROUP BY source, size_action""", SIZED)
_sql("redaction_coverage", """
  SELECT key, CASE WHEN key IN ('api_key', 'cvv', 'password') THEN 1 WHEN key = 'token' THEN 2 ELSE 0 END
    * (SELECT count(*) FROM documents) AS redactions
  FROM (SELECT unnest(['password', 'passwd', 'secret', 'token', 'api_key', 'apikey', 'api_secret', 'access_token',
    'refresh_token', 'authorization', 'auth', 'credential', 'credentials', 'private_key', 'ssh_key', 'session_id',
    'session_token', 'cookie', 'credit_card', 'card_number', 'cvv', 'ssn']) AS key)""")

SPANS = f"""src AS (SELECT *, {K} AS k, CAST(floor(value) AS BIGINT) AS done, md5(CAST(event_id AS VARCHAR)) AS trace_id,
    CASE event_type WHEN 'view' THEN 'ChatCompletions' WHEN 'click' THEN 'Messages' WHEN 'signup' THEN 'CreateEmbeddings'
      ELSE 'tools/call' END AS name,
    event_type = 'view' AND {K} % 10 = 0 AS failed, 's' || user_id AS corr FROM events),
  spans AS (SELECT *, CASE WHEN event_type IN ('view', 'click', 'signup') THEN 'llm'
      WHEN event_type = 'error' AND k % 3 = 2 THEN 'none' ELSE 'mcp' END AS kind,
    CASE WHEN event_type IN ('view', 'click', 'signup') THEN 'llm' WHEN event_type = 'purchase' OR k % 3 = 0 THEN 'mcp'
      WHEN k % 3 = 1 THEN 'filtered' ELSE 'ignored' END AS outcome,
    ['openai', 'anthropic', 'google'][user_id % 3 + 1] AS provider FROM src)"""
_sql("decode_traces", """
  SELECT trace_id, substr(trace_id, 1, 16) AS span_id, name, epoch_us(ts) * 1000 AS start_ns,
    epoch_us(ts) * 1000 + CAST(floor(value * 1000) AS BIGINT) * 1000 AS end_ns, 'gateway' AS scope,
    CASE WHEN failed THEN 'upstream 429' END AS status_message,
    CASE event_type WHEN 'view' THEN 13 WHEN 'click' THEN 4 WHEN 'signup' THEN 2 WHEN 'purchase' THEN 6
      ELSE CASE WHEN k % 3 = 0 THEN 3 ELSE 1 END END::BIGINT AS n_attrs
  FROM spans""", SPANS)
ATTRIBUTES = (
    ("openinference.span.kind", "view", "'LLM'"), ("llm.system", "view", "provider"),
    ("llm.model_name", "view", "'model-' || (k % 5)"), ("llm.token_count.prompt", "view", "k"),
    ("llm.token_count.completion", "view", "done"), ("llm.token_count.total", "view", "k + done"),
    ("llm.invocation_parameters", "view", "1"), ("input.value", "view", "k"),
    ("llm.output_messages.0.message.role", "view", "1"), ("llm.output_messages.0.message.content", "view", "k"),
    ("llm.output_messages.0.message.tool_calls.0.tool_call.function.name", "view", "k % 4"),
    ("http.client_ip", "view", "user_id"), ("corr.session", "view", "user_id"),
    ("span.kind", "click", "1"), ("llm.model", "click", "k % 3"), ("gen_ai.usage.input_tokens", "click", "k"),
    ("corr.session", "click", "user_id"), ("openinference.span.kind", "signup", "'EMBEDDING'"),
    ("embedding.invocation_parameters", "signup", "k % 2"), ("mcp.method.name", "purchase", "'tools/call'"),
    ("mcp.tool.name", "purchase", "k % 4"), ("mcp.tool.arguments", "purchase", "k"), ("corr.session", "purchase", "user_id"),
    ("mcp.backend.name", "purchase", "user_id % 7"), ("mcp.session.id", "purchase", "user_id"),
    ("mcp.method.name", "listing", "'tools/list'"), ("mcp.backend.name", "listing", "user_id % 7"),
    ("output.value", "listing", "k % 2"), ("mcp.method.name", "start", "'initialize'"), ("upstream.cluster", "noise", "1"),
)
ATTRS = "roles AS (SELECT *, CASE WHEN event_type <> 'error' THEN event_type ELSE " \
    "['listing', 'start', 'noise'][k % 3 + 1] END AS role FROM spans), attrs AS (" + " UNION ALL ".join(
        f"SELECT '{name}' AS name, trace_id, CAST({value} AS VARCHAR) AS v FROM roles WHERE role = '{role}'"
        for name, role, value in ATTRIBUTES) + ")"
_sql("span_attributes", "SELECT name, count(*) AS spans, count(DISTINCT v) AS distinct_values FROM attrs GROUP BY name",
     SPANS, ATTRS)
_sql("nested_span_attributes", f"""
  SELECT CAST({K} AS VARCHAR) AS name, 'NaN' AS bad, CAST({K} AS VARCHAR) AS good, 'hi' AS nested_raw, '-Infinity' AS first,
    '0.5' AS second, 'base64:/w==' AS raw, count(*) AS n FROM events GROUP BY 1, 3""")
ODD = "CASE event_id % " + str(len(ODD_EXPORTS)) + " " + " ".join(f"WHEN {i} THEN '{r or 'sound'}'" for i, (r, _) in enumerate(ODD_EXPORTS)) + " END"
_sql("odd_exports", f"""
  SELECT {ODD} AS reason, CASE WHEN {ODD} = 'sound' THEN 'n' || {K} END AS name, count(*) AS exports,
    CAST(CASE WHEN {ODD} = 'sound' THEN 7 * count(*) END AS BIGINT) AS total FROM events GROUP BY 1, 2""")
_sql("quarantine_undecodable", f"""
  SELECT CASE {K} % 7 WHEN 0 THEN 'undecodable' WHEN 1 THEN 'too_large' ELSE 'good' END AS reason, count(*) AS n
  FROM events GROUP BY 1""")
_sql("classify_spans", "SELECT name, kind, count(*) AS n FROM spans GROUP BY name, kind", SPANS)
_sql("map_llm_spans", f"""
  SELECT trace_id, 'llm://' || CASE event_type WHEN 'view' THEN provider WHEN 'click' THEN 'unknown' ELSE 'openai' END || '/' ||
      CASE event_type WHEN 'view' THEN 'model-' || (k % 5) WHEN 'click' THEN 'claude-' || (k % 3)
        ELSE 'text-embedding-' || (k % 2) END AS endpoint,
    CASE event_type WHEN 'view' THEN 'llm_chat_completion' WHEN 'click' THEN 'llm_messages' ELSE 'llm_embeddings' END AS method,
    CASE event_type WHEN 'view' THEN 'chat_completion' WHEN 'click' THEN 'messages' ELSE 'embeddings' END AS event_type,
    CASE WHEN event_type = 'view' THEN {IP} END AS remote_addr, CASE WHEN failed THEN 'error' ELSE 'ok' END AS status,
    CASE WHEN failed THEN 'upstream 429' END AS error, round(floor(value * 1000) / 1000, 6) AS duration_ms,
    CASE WHEN event_type IN ('view', 'click') THEN k END AS tokens_prompt,
    CASE WHEN event_type = 'view' THEN done END AS tokens_completion, CASE WHEN event_type = 'view' THEN k + done END AS tokens_total,
    epoch_us(ts) AS ts_us, CASE WHEN event_type = 'view' THEN 'q' || k END AS asked,
    CASE WHEN event_type = 'view' THEN 'answer ' || k END AS answered, CASE WHEN event_type = 'view' THEN 'tool-' || (k % 4) END AS tool,
    CASE WHEN event_type = 'view' THEN 0.5 END::DOUBLE AS temperature
  FROM spans WHERE outcome = 'llm'""", SPANS)
_sql("map_mcp_spans", """
  SELECT trace_id, 'mcp://server-' || (user_id % 7) || '/' ||
      CASE WHEN event_type = 'purchase' THEN 'tool-' || (k % 4) ELSE 'schema_report' END AS endpoint,
    CASE WHEN event_type = 'purchase' THEN 'mcp_tool_call' ELSE 'mcp_schema_report' END AS method,
    CASE WHEN event_type = 'purchase' THEN corr END AS session_id,
    CASE WHEN event_type = 'purchase' THEN 'tool-' || (k % 4) END AS handler_name, 'server-' || (user_id % 7) AS mcp_server,
    CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS item,
    CASE WHEN event_type = 'purchase' THEN 'abc' END AS token, CASE WHEN event_type = 'purchase' THEN 0 ELSE 2 END::BIGINT AS n_tools
  FROM spans WHERE outcome = 'mcp'""", SPANS)
_sql("drop_unroutable_mcp", """
  SELECT CASE outcome WHEN 'mcp' THEN 'kept' ELSE 'dropped' END AS fate, trace_id FROM spans
  WHERE outcome IN ('mcp', 'filtered')""", SPANS)
_sql("copy_extra_attributes", f"""
  SELECT trace_id, {_hmac('corr')} AS corr_session FROM spans WHERE event_type IN ('view', 'click', 'purchase')""", SPANS)
TAGS = """'{"a":null,"b":[1,"' || """ + K + """ || '"]}'"""
_sql("structured_extras", f"""
  SELECT event_id, '{{"acme.apiKey":"[REDACTED]","billing-credit-card":"[REDACTED]","deep":[{{"ok":' || {K} ||
    ',"userPassword":"[REDACTED]"}}],"plan":"p' || {K} || '"}}' AS profile, {_hmac(TAGS)} AS tags FROM events""")
_sql("rebuild_conversations", """
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, role, md5(text) AS content_md5
  FROM conversations""")
_sql("finalize_events", f"""
  SELECT trace_id, kind, CASE WHEN event_type = 'view' THEN {_hmac(IP)} ELSE 'unknown' END AS remote_addr,
    CASE WHEN kind = 'llm' THEN 'llm://' || CASE event_type WHEN 'view' THEN provider WHEN 'click' THEN 'unknown' ELSE 'openai' END
        || '/' || CASE event_type WHEN 'view' THEN 'model-' || (k % 5) WHEN 'click' THEN 'claude-' || (k % 3)
        ELSE 'text-embedding-' || (k % 2) END
      ELSE 'mcp://server-' || (user_id % 7) || '/' ||
        CASE WHEN event_type = 'purchase' THEN 'tool-' || (k % 4) ELSE 'schema_report' END END AS endpoint,
    'fits' AS size_action, CASE WHEN event_type = 'view' THEN '[REDACTED]' END AS sent_key,
    CASE WHEN event_type = 'purchase' THEN '[REDACTED]' END AS token,
    CASE WHEN event_type IN ('view', 'click', 'purchase') THEN {_hmac('corr')} END AS corr_session,
    CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS item
  FROM spans WHERE outcome IN ('llm', 'mcp')""", SPANS)
_sql("outcome_accounting", """
  SELECT count(*) FILTER (outcome = 'ignored') AS ignored, count(*) FILTER (outcome = 'filtered') AS filtered,
    0::BIGINT AS oversize, 0::BIGINT AS queue_full, 0::BIGINT AS health, 0::BIGINT AS path, 0::BIGINT AS unsampled,
    0::BIGINT AS http, count(*) FILTER (outcome = 'llm') AS llm,
    count(*) FILTER (outcome = 'mcp') AS mcp, count(*) AS received FROM spans""", SPANS)
_sql("stored_accounting", """
  SELECT outcome, coalesce(n, 0) AS counted, CASE WHEN outcome IN ('llm', 'mcp', 'http') THEN coalesce(n, 0) ELSE 0 END AS stored
  FROM (VALUES ('ignored'), ('filtered'), ('oversize'), ('queue_full'), ('health'), ('path'), ('unsampled'), ('llm'), ('mcp'), ('http'))
    AS o(outcome) LEFT JOIN (
      SELECT outcome, count(*) AS n FROM spans GROUP BY 1
      UNION ALL SELECT CASE WHEN starts_with(endpoint, '/de/') THEN 'path' ELSE 'http' END, count(*) FROM requests GROUP BY 1) USING (outcome)""",
     SPANS, REQUESTS)
_sql("repeated_arguments", """
  SELECT epoch_us(date_trunc('day', ts)) AS window_us, 'tool-' || (k % 4) AS handler_name,
    sha256('{"item":' || k || ',"token":"[REDACTED]"}') AS args_hash, count(*) AS calls
  FROM spans WHERE event_type = 'purchase' GROUP BY 1, 2, 3""", SPANS)
_sql("refused_accounting", f"""
  SELECT count(*) FILTER (outcome = 'ignored') AS ignored, count(*) FILTER (outcome = 'filtered') AS filtered,
    0::BIGINT AS oversize, 0::BIGINT AS queue_full, 0::BIGINT AS health, 0::BIGINT AS path, 0::BIGINT AS unsampled,
    0::BIGINT AS http, count(*) FILTER (outcome = 'llm') AS llm,
    count(*) FILTER (outcome = 'mcp') AS mcp, count(*) AS received,
    (SELECT count(*) FROM events WHERE {K} % 7 = 0) AS exports_undecodable,
    (SELECT count(*) FROM events WHERE {K} % 7 = 1 AND event_id % 50 = 0) AS exports_too_large,
    0::BIGINT AS exports_unsound FROM spans""", SPANS)
WORDS = r"regexp_replace(lower(regexp_replace(regexp_replace(name, '([a-z0-9])([A-Z])', '\1_\2', 'g'), '([A-Z])([A-Z][a-z])', '\1_\2', 'g')), '[^a-z0-9]+', '_', 'g')"
RISKY = "(^|_)(password|passwd|secret|token|api_key|apikey|api_secret|access_token|refresh_token|authorization|auth|" \
    "credential|credentials|private_key|ssh_key|session_id|session_token|cookie|credit_card|card_number|cvv|ssn)(_|$)"
OWNED_SQL = """name IN ('llm.model_name', 'embedding.model_name', 'llm.model', 'gen_ai.request.model', 'llm.system', 'gen_ai.provider.name',
    'gen_ai.system', 'gen_ai.response.model', 'input.value', 'gen_ai.input.value', 'gen_ai.request.input', 'output.value',
    'gen_ai.output.value', 'http.route', 'url.path', 'http.target', 'llm.invocation_parameters', 'embedding.invocation_parameters',
    'openinference.span.kind', 'gen_ai.operation.name', 'llm.input_messages', 'llm.output_messages', 'error.type', 'mcp.method.name',
    'mcp.backend.name', 'mcp.backend', 'mcp.server.name', 'mcp.session.id', 'session.id', 'mcp.client.name', 'mcp.client.version',
    'mcp.request.id', 'mcp.transport', 'mcp.protocol.version', 'mcp.tool.arguments', 'mcp.request.arguments', 'mcp.tool.call.arguments',
    'mcp.tools.list', 'llm.token_count.prompt', 'gen_ai.usage.input_tokens', 'llm.token_count.completion', 'gen_ai.usage.output_tokens',
    'llm.token_count.total', 'gen_ai.usage.total_tokens', 'llm.token_count.prompt_details.cache_read', 'llm.token_count.prompt_cache_hit',
    'llm.token_count.prompt_details.cache_creation', 'llm.token_count.completion_details.reasoning',
    'llm.token_count.completion.reasoning', 'llm.token_count.completion_reasoning', 'mcp.tool.name', 'mcp.resource.uri', 'mcp.prompt.name')
    OR starts_with(name, 'llm.input_messages.') OR starts_with(name, 'llm.output_messages.')
    OR starts_with(name, 'gen_ai.request.') OR starts_with(name, 'mcp.request.argument.')"""
_sql("attribute_catalog", f"""
  SELECT name, {WORDS} AS derived_key, regexp_matches({WORDS}, '{RISKY}') AS sensitive, ({OWNED_SQL}) AS owned, spans,
    count(*) OVER (PARTITION BY {WORDS}) AS names_with_key
  FROM (SELECT name, count(*) AS spans FROM attrs GROUP BY name)""", SPANS, ATTRS)
_sql("name_sensitivity", f"""
  SELECT name, {WORDS} AS derived_key, regexp_matches({WORDS}, '{RISKY}') AS sensitive, count(*) AS spans FROM (
    SELECT 'http.request.' || replace(p_name, ' ', '-') AS name FROM part
    UNION ALL SELECT 'X-Api-Key.' || p_type FROM part) GROUP BY name""")
_sql("requested_vs_observed", f"""
  SELECT corr, tool, coalesce(requested, 0) AS requested, coalesce(observed, 0) AS observed,
    CASE WHEN observed IS NULL THEN 'requested_only' WHEN requested IS NULL THEN 'observed_only'
      WHEN requested = observed THEN 'equal' ELSE 'differs' END AS verdict
  FROM (SELECT {_hmac('corr')} AS corr, 'tool-' || (k % 4) AS tool, count(*) AS requested FROM spans
      WHERE event_type = 'view' GROUP BY 1, 2)
    FULL JOIN (SELECT {_hmac('corr')} AS corr, 'tool-' || (k % 4) AS tool, count(*) AS observed FROM spans
      WHERE event_type = 'purchase' GROUP BY 1, 2) USING (corr, tool)""", SPANS)

_sql("read_mcp_calls", f"""
  SELECT event_id, 'mcp://server-' || (user_id % 7) || '/' || event_type AS endpoint, 'mcp_tool_call' AS method,
    CASE WHEN user_id % 3 > 0 THEN {_hmac(IP)} ELSE 'mcp-local' END AS remote_addr,
    CASE WHEN user_id % 4 > 0 THEN 'session-' || user_id ELSE 'no-session' END AS session_id, 'user-' || user_id AS user_id,
    round(value / 3, 2) AS duration_ms, CASE WHEN event_type = 'error' THEN 'ValueError' END AS error,
    CASE WHEN event_type <> 'error' THEN {SUMMARY} END AS result_summary,
    CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status FROM events""")
DECLARED = f"""reports AS (SELECT event_id, ts, 'server-' || (user_id % 7) AS mcp_server, {K} AS k FROM events
    WHERE event_type = 'purchase'),
  inventory AS (
    SELECT event_id, ts, mcp_server, 'tool' AS item_kind, 'purchase' AS name, 'v' || (k % 2) AS description FROM reports
    UNION ALL SELECT event_id, ts, mcp_server, 'tool', 'refund', 'static' FROM reports
    UNION ALL SELECT event_id, ts, mcp_server, 'resource', 'doc://' || (k % 3), '' FROM reports
    UNION ALL SELECT event_id, ts, mcp_server, 'prompt', 'greet', '' FROM reports WHERE k % 2 = 0)"""
_sql("read_schema_reports", "SELECT event_id, mcp_server, item_kind, name, description FROM inventory", DECLARED)
_sql("one_report_per_server", """
  SELECT mcp_server, item_kind, name, count(DISTINCT description) AS definitions, min(event_id) AS first_event
  FROM inventory GROUP BY 1, 2, 3""", DECLARED)
_sql("undeclared_calls", """
  SELECT mcp_server, handler_name AS name, count(*) AS calls, min(epoch_us(ts)) AS first_us FROM calls c
  WHERE NOT EXISTS (SELECT 1 FROM inventory i WHERE i.mcp_server = c.mcp_server AND i.name = c.handler_name)
  GROUP BY 1, 2""", CALLS, DECLARED)
_sql("never_called", """
  SELECT mcp_server, item_kind, name, max(epoch_us(ts)) AS declared_us FROM inventory i
  WHERE NOT EXISTS (SELECT 1 FROM calls c WHERE i.mcp_server = c.mcp_server AND i.name = c.handler_name)
  GROUP BY 1, 2, 3""", CALLS, DECLARED)
_sql("definition_drift", """
  SELECT mcp_server, item_kind, name, event_id, epoch_us(prev_ts) AS prev_us FROM (
    SELECT *, lag(ts) OVER w AS prev_ts, lag(description) OVER w AS before FROM inventory
    WINDOW w AS (PARTITION BY mcp_server, item_kind, name ORDER BY ts, event_id)) WHERE before <> description""", DECLARED)

_sql("endpoint_inventory", """
  SELECT kind, endpoint, method, count(*) AS calls, count(*) FILTER (status = 'error') AS errors,
    round(sum(duration_ms), 2) AS sum_duration_ms, round(quantile_cont(duration_ms, 0.95), 6) AS p95_duration_ms,
    min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us FROM calls GROUP BY 1, 2, 3""", CALLS)
_sql("observed_arguments", """
  SELECT 'mcp://server-' || (user_id % 7) || '/' || event_type AS endpoint, argument, count(*) AS calls
  FROM events, (SELECT unnest(['item', 'token', 'note', 'nested']) AS argument) GROUP BY 1, 2""")
_sql("call_graph", """
  SELECT handler_name AS src, next AS dst, count(*) AS n, round(sum(gap), 6) AS sum_gap_s, round(min(gap), 6) AS min_gap_s,
    round(max(gap), 6) AS max_gap_s
  FROM (SELECT handler_name, lead(handler_name) OVER w AS next, (epoch_us(lead(ts) OVER w) - epoch_us(ts)) / 1e6 AS gap FROM calls
    WINDOW w AS (PARTITION BY session_id ORDER BY ts, event_id)) WHERE next IS NOT NULL GROUP BY 1, 2""", CALLS)
_sql("chain_matches", """
  SELECT event_id, first_event_id, round((epoch_us(ts) - epoch_us(first_ts)) / 1e6, 6) AS gap_s FROM (
    SELECT s.event_id, s.ts, f.event_id AS first_event_id, f.ts AS first_ts,
      row_number() OVER (PARTITION BY s.event_id ORDER BY f.ts DESC, f.event_id DESC) AS r
    FROM calls s JOIN calls f ON s.session_id = f.session_id AND f.handler_name = 'view' AND f.ts < s.ts
      AND f.ts >= s.ts - INTERVAL 6 HOUR WHERE s.handler_name = 'purchase') WHERE r = 1""", CALLS)
_sql("repeated_failures", """
  SELECT session_id, count(*) AS failures, min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us FROM (
    SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY ts, event_id)
      - row_number() OVER (PARTITION BY session_id, status ORDER BY ts, event_id) AS island FROM calls)
  WHERE status = 'error' GROUP BY session_id, island HAVING count(*) >= 2""", CALLS)
_sql("call_loops", """
  SELECT epoch_us(date_trunc('day', ts)) AS window_us, session_id, handler_name, count(*) AS calls FROM calls
  GROUP BY 1, 2, 3 HAVING count(*) >= 2""", CALLS)
_sql("sessionize", """
  SELECT event_id, user_id, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT AS session_no FROM (
    SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 12 HOUR THEN 1 ELSE 0 END AS fresh FROM calls
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""", CALLS)
_sql("token_consumption", """
  SELECT epoch_us(day) AS window_us, provider, model, GROUPING(day, provider, model)::BIGINT AS level, count(*) AS calls,
    sum(tokens_total)::BIGINT AS tokens
  FROM (SELECT *, date_trunc('day', ts) AS day FROM calls) GROUP BY ROLLUP (day, provider, model)""", CALLS)
_sql("token_spikes", """
  SELECT provider, model, epoch_us(day) AS window_us, tokens, round(m, 6) AS trailing_mean FROM (
    SELECT *, avg(tokens) OVER (PARTITION BY provider, model ORDER BY day ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS m FROM (
      SELECT provider, model, date_trunc('day', ts) AS day, sum(tokens_total)::BIGINT AS tokens FROM calls GROUP BY 1, 2, 3))
  WHERE tokens > 1.5 * m""", CALLS)
_sql("user_activity_baseline", """
  SELECT user_id, CAST(day AS VARCHAR) AS day, calls, round(m, 6) AS mean_calls, round(s, 6) AS stddev_calls,
    CASE WHEN s > 0 THEN round((calls - m) / s, 6) END AS z_score FROM (
    SELECT *, avg(calls) OVER w AS m, stddev_pop(calls) OVER w AS s FROM (
      SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS calls FROM calls GROUP BY 1, 2) WINDOW w AS (PARTITION BY user_id))""",
     CALLS)
_sql("top_consumers", """
  SELECT user_id, count(*) AS calls, count(*) FILTER (status = 'error') AS errors, sum(tokens_total)::BIGINT AS tokens
  FROM calls GROUP BY 1 ORDER BY tokens DESC, user_id LIMIT 10""", CALLS)
_sql("top_consumers_by_provider", """
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY provider ORDER BY tokens DESC, user_id) AS rank FROM (
    SELECT provider, user_id, count(*) AS calls, count(*) FILTER (status = 'error') AS errors, sum(tokens_total)::BIGINT AS tokens
    FROM calls GROUP BY 1, 2)) WHERE rank <= 5""", CALLS)
_sql("correlate_llm_mcp", """
  SELECT m.user_id, m.event_id AS mcp_event_id, l.event_id AS llm_event_id, l.model,
    round((epoch_us(m.ts) - epoch_us(l.ts)) / 1e6, 6) AS lag_s
  FROM (SELECT * FROM calls WHERE kind = 'mcp') m ASOF JOIN (SELECT * FROM calls WHERE kind = 'llm') l
    ON m.user_id = l.user_id AND m.ts > l.ts WHERE m.ts - l.ts <= INTERVAL 4 HOUR""", CALLS)
_sql("order_volume", """
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY tokens DESC, user_id) AS rank FROM (
    SELECT o_orderpriority AS model, o_custkey AS user_id, count(*) AS calls, count(*) FILTER (o_orderstatus = 'F') AS errors,
      sum(CAST(floor(o_totalprice) AS BIGINT))::BIGINT AS tokens FROM orders GROUP BY 1, 2)) WHERE rank <= 3""")

_sql("admit_bounded", """
  SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY date_trunc('hour', ts), mcp_server
    ORDER BY ts, event_id) AS r FROM calls) WHERE r <= 3""", CALLS)
_sql("admit_bounded_large", """
  SELECT row FROM (SELECT l_orderkey * 8 + l_linenumber AS row FROM lineitem ORDER BY l_shipdate, row LIMIT 10000)""")
_sql("admission_report", """
  SELECT epoch_us(date_trunc('day', ts)) AS window_us, mcp_server, least(count(*), 3)::BIGINT AS admitted,
    greatest(count(*) - 3, 0)::BIGINT AS dropped FROM calls GROUP BY 1, 2""", CALLS)
_sql("scale_sampled_counts", """
  SELECT handler_name, count(*) AS sampled, round(count(*) / 0.25::DOUBLE, 6) AS estimated,
    round(sqrt(count(*) * 0.75) / 0.25, 6) AS std_error FROM calls
  WHERE ('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::UBIGINT / 4294967296.0 < 0.25 GROUP BY 1""", CALLS)
_sql("batch_envelopes", """
  SELECT kind, batch_no, count(*) AS n, min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us,
    md5('{"events":[' || string_agg('{"event_id":' || event_id || '}', ',' ORDER BY ts, event_id) || ']}') AS envelope_md5
  FROM (SELECT *, (row_number() OVER (PARTITION BY kind ORDER BY ts, event_id) - 1) // 50 AS batch_no FROM calls)
  GROUP BY 1, 2""", CALLS)
_sql("to_wire", f"""
  SELECT page_id, CASE WHEN scheme = 'https' THEN 'true' ELSE 'false' END AS scheme,
    strftime(make_timestamp(ts_us), '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp,
    (SELECT string_agg(value, ',') FROM params p WHERE p.page_id = k.page_id AND name = 'page') AS q_page,
    {_hmac("'10.1.0.' || (page_id % 250)")} AS remote_addr, ({BODY}) AS has_body
  FROM kept k""", REQUESTS, KEPT, PARAMS)
_sql("delivery_accounting", """
  SELECT sum(CASE WHEN status = 'ok' THEN 50 ELSE 0 END)::BIGINT AS posted, count(*) FILTER (status <> 'ok') AS post_failures,
    sum(CASE WHEN status = 'ok' THEN k ELSE 0 END)::BIGINT AS accepted,
    sum(CASE WHEN status = 'ok' THEN 100 - k ELSE 0 END)::BIGINT AS skipped FROM calls""", CALLS)
_sql("deliver_once", """
  SELECT count(*) AS posted, 0::BIGINT AS post_failures, count(*) AS accepted, 0::BIGINT AS skipped FROM events""")
_sql("deliver_batches", """
  SELECT count(*) AS posted, 0::BIGINT AS post_failures, count(*) AS accepted, 0::BIGINT AS skipped FROM events""")
_sql("windowed_tokens", """
  SELECT epoch_us(w) AS window_us, provider, count(*) AS calls, sum(tokens_total)::BIGINT AS tokens FROM (
    SELECT *, date_trunc('hour', ts) AS w FROM calls UNION ALL SELECT *, date_trunc('hour', ts) - INTERVAL 1 HOUR FROM calls)
  GROUP BY 1, 2""", CALLS)
_sql("session_totals", """
  SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 43200000000 AS end_us, count(*) AS calls FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM (
      SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 12 HOUR THEN 1 ELSE 0 END AS fresh FROM calls
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))) GROUP BY user_id, n""", CALLS)
_sql("correlate_windows", """
  SELECT epoch_us(w) AS window_us, user_id, llm_calls, mcp_calls FROM (
    SELECT date_trunc('day', ts) AS w, user_id, count(*) FILTER (kind = 'llm') AS llm_calls,
      count(*) FILTER (kind = 'mcp') AS mcp_calls FROM calls GROUP BY 1, 2) WHERE llm_calls > 0 AND mcp_calls > 0""", CALLS)
_sql("dedup_spans", """
  SELECT DISTINCT md5(CAST(event_id % 5000 AS VARCHAR)) AS trace_id, event_id % 2 AS span_id FROM events""")
_sql("stream_calls", f"""
  SELECT event_id, {_hmac('user_id')} AS user_id, endpoint, epoch_us(ts) AS ts_us FROM calls
  WHERE status = 'ok' AND ('0x' || substr(md5(session_id), 1, 8))::UBIGINT / 4294967296.0 < 0.5""", CALLS)
_sql("stream_windowed_tokens", """
  SELECT epoch_us(w) AS window_us, provider, count(*) AS calls, sum(tokens_total)::BIGINT AS tokens
  FROM (SELECT *, date_trunc('day', ts) AS w FROM calls) GROUP BY 1, 2""", CALLS)
# What a stream has said when its input ends: windows and sessions that end before the watermark, ten minutes behind.
PASSED = "(SELECT max(epoch_us(ts)) // 1000 * 1000 - 600000000 FROM calls{})"
_sql("stream_loops", """
  SELECT epoch_us(date_trunc('day', ts)) AS window_us, session_id, handler_name, count(*) AS calls FROM calls
  GROUP BY 1, 2, 3 HAVING count(*) >= 2""", CALLS)
_sql("stream_session_totals", f"""
  SELECT * FROM (
    SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 43200000000 AS end_us, count(*) AS calls FROM (
      SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM (
        SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts - lag(ts) OVER w > INTERVAL 12 HOUR THEN 1 ELSE 0 END AS fresh FROM calls
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))) GROUP BY user_id, n)
  WHERE end_us <= {PASSED.format("")}""", CALLS)
_sql("stream_correlate_windows", f"""
  SELECT epoch_us(w) AS window_us, user_id, llm_calls, mcp_calls FROM (
    SELECT date_trunc('day', ts) AS w, user_id, count(*) FILTER (kind = 'llm') AS llm_calls,
      count(*) FILTER (kind = 'mcp') AS mcp_calls FROM calls GROUP BY 1, 2) WHERE llm_calls > 0 AND mcp_calls > 0
    AND epoch_us(w) + 86400000000 <= least({PASSED.format(" WHERE kind = 'llm'")}, {PASSED.format(" WHERE kind = 'mcp'")})""", CALLS)
_sql("stream_failure_streaks", """
  SELECT session_id, count(*) AS failures, min(epoch_us(ts)) AS first_us, max(epoch_us(ts)) AS last_us FROM (
    SELECT *, count(*) FILTER (status <> 'error') OVER (PARTITION BY session_id ORDER BY ts DESC, event_id DESC) AS after FROM calls)
  WHERE after = 0 GROUP BY session_id HAVING count(*) >= 2""", CALLS)
_sql("stream_dedup_spans", """
  SELECT DISTINCT md5(CAST(event_id % 5000 AS VARCHAR)) AS trace_id, event_id % 2 AS span_id FROM events""")
