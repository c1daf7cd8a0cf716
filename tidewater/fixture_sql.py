"""Input derivations shared by the Spark queries and their DuckDB twins.

These SQL expressions (valid in both dialects) build the texts the
reference would receive from remote services - model answers, response
bodies - from the ``events`` table, one per row, so both engines see
byte-identical inputs.  The variant of each row is chosen by event_id.
"""

K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"

EXTRACTION_BASE = (
    "'{\"summary\": \"Event ' || CAST(event_id AS STRING) || ' of type ' || event_type || "
    "' was reported by user ' || CAST(user_id AS STRING) || ' today.\", \"mentions_cooling_or_water\": ' || "
    "CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END || ', \"cooling_water_summary\": ' || "
    "CASE WHEN k % 3 = 0 THEN 'null' ELSE '\"k is ' || CAST(k AS STRING) || '\"' END || "
    "', \"people\": [{\"full_name\": \" User ' || CAST(user_id AS STRING) || ' \", \"primary_title\": \"Analyst\", "
    "\"primary_company\": \"' || event_type || ' Group\", \"lead_relevance\": \"' || "
    "CASE k % 4 WHEN 0 THEN 'High' WHEN 1 THEN 'Medium' WHEN 2 THEN 'Urgent' ELSE 'Low' END || "
    "'\", \"notes\": 5}, {\"full_name\": \"  \"}, 7], \"companies\": [{\"name\": \"' || event_type || "
    "' Group\", \"sector\": \"Retail\", \"country\": \"US\", \"notes\": null}, {\"name\": \"\"}], \"country\": \"' || "
    "CASE WHEN k % 5 = 0 THEN ' ' ELSE 'DE' END || '\"}'"
)

EXTRACTION_ANSWER = f"""CASE event_id % 7
  WHEN 0 THEN {EXTRACTION_BASE}
  WHEN 1 THEN '```json' || chr(10) || {EXTRACTION_BASE} || chr(10) || '```'
  WHEN 2 THEN 'Here is the answer: ' || {EXTRACTION_BASE} || ' Thanks!'
  WHEN 3 THEN left({EXTRACTION_BASE}, 60)
  WHEN 4 THEN '{{"summary": "' || event_type || ' event", "mentions_cooling_or_water": true, "people": [], '
              || '"companies": {{"name": "x"}}, "country": null}}'
  WHEN 5 THEN '[' || {EXTRACTION_BASE} || ']'
  ELSE '{{"mentions_cooling_or_water": "false", "people": [{{"full_name": "Ann ' || CAST(user_id AS STRING)
       || '", "lead_relevance": "High"}}], "companies": [], "summary": "A sufficiently long summary sentence '
       || 'for event ' || CAST(event_id AS STRING) || '."}}'
END"""

BRIEFING_BASE = (
    "'{\"summary\": \"Event ' || CAST(event_id AS STRING) || ' summary.\", \"author\": \"User ' || "
    "CAST(user_id AS STRING) || '\", \"entities\": [\"' || event_type || ' (Type)\", \"Value ' || "
    "CAST(k AS STRING) || '\"], \"relevance_score\": ' || CAST(k % 10 + 1 AS STRING) || '}'"
)

BRIEFING_ANSWER = f"""CASE event_id % 7
  WHEN 0 THEN {BRIEFING_BASE}
  WHEN 1 THEN '```json' || chr(10) || {BRIEFING_BASE} || chr(10) || '```'
  WHEN 2 THEN '```' || {BRIEFING_BASE} || '```'
  WHEN 3 THEN ' ```json' || {BRIEFING_BASE} || '```'
  WHEN 4 THEN 'Invalid JSON'
  WHEN 5 THEN {BRIEFING_BASE} || chr(10)
  ELSE '```json' || {BRIEFING_BASE} || '``` '
END"""

FALLBACK_ANSWER = ("'{\"summary\": \"Fallback for ' || CAST(event_id AS STRING) || "
                   "'\", \"author\": \"Jane Doe\", \"entities\": [], \"relevance_score\": 5}'")

RESPONSE_BODY = """CASE event_id % 7
  WHEN 0 THEN '{"choices": [{"message": {"role": "assistant", "content": "k=' || CAST(k AS STRING) || '"}}]}'
  WHEN 1 THEN '{"choices": []}'
  WHEN 2 THEN '{"error": "rate limited"}'
  WHEN 3 THEN '{"choices": [{"message": {"content": ' || CAST(k AS STRING) || '}}]}'
  WHEN 4 THEN 'not json'
  WHEN 5 THEN '{"choices": [{"message": {"content": null}}]}'
  ELSE '{"choices": [{"message": {"content": "first"}}, {"message": {"content": "second"}}]}'
END"""

ANSWERS = f"""
SELECT event_id, ts, user_id, event_type, k,
       'Event ' || CAST(event_id AS STRING) || ' ' || event_type AS title,
       {EXTRACTION_ANSWER} AS extraction_answer,
       {BRIEFING_ANSWER} AS briefing_answer,
       {FALLBACK_ANSWER} AS fallback_answer,
       CASE WHEN event_type = 'error' THEN 'API Error' END AS primary_error,
       {RESPONSE_BODY} AS response_body
FROM (SELECT *, {K} AS k FROM events) e"""

# Orders as articles that mention their customer (a person at the
# customer's nation) and two companies: the nation and the region.
# Name spellings vary with order status / priority so that keys collide.
ORDER_MENTIONS = """
SELECT o.o_orderkey AS article_id, o.o_orderkey AS article_pos,
  'https://news.example.com/orders/' || CAST(o.o_orderkey AS STRING) AS article_url,
  'Order ' || CAST(o.o_orderkey AS STRING) || ' ' || o.o_orderpriority AS article_title,
  CASE o.o_orderstatus WHEN 'F' THEN c.c_name WHEN 'O' THEN lower(c.c_name) ELSE ' ' || c.c_name || ' ' END
    AS person_name,
  'Buyer' AS person_title,
  CASE WHEN c.c_acctbal < 0 THEN NULL ELSE n.n_name END AS person_company,
  CASE c.c_mktsegment WHEN 'BUILDING' THEN 'High' WHEN 'MACHINERY' THEN 'Medium' WHEN 'HOUSEHOLD' THEN NULL
       ELSE 'Low' END AS person_relevance,
  'Ordered ' || o.o_orderpriority AS person_notes,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN lower(n.n_name) WHEN '2-HIGH' THEN ' ' || n.n_name || ' '
       ELSE n.n_name END AS company1_name,
  r.r_name AS company1_country,
  r.r_name AS company2_name
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey"""

# Stored tables the run resolves against.
EXISTING_COMPANIES = """
SELECT CAST(n_nationkey + 1000 AS BIGINT) AS company_id, lower(n_name) AS name FROM nation WHERE n_regionkey < 2
UNION ALL
SELECT CAST(n_nationkey + 2000 AS BIGINT) AS company_id, lower(n_name) AS name FROM nation WHERE n_regionkey = 0"""

EXISTING_PEOPLE = """
SELECT c.c_custkey AS person_id, c.c_name AS full_name,
       CASE WHEN c.c_acctbal < 0 THEN NULL ELSE n.n_name END AS primary_company
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey WHERE c.c_mktsegment = 'BUILDING'"""

EXISTING_ARTICLE_PEOPLE = "SELECT o_orderkey AS article_id, o_custkey AS person_id FROM orders WHERE o_orderstatus = 'F'"

# Every line item of an order mentions the order's customer again.
LINE_LINKS = """
SELECT l.l_orderkey AS article_id, l.l_orderkey AS article_pos, l.l_linenumber AS elem_pos,
       m.person_name, m.person_company, m.person_notes, m.article_url, m.article_title
FROM lineitem l JOIN (""" + ORDER_MENTIONS + """) m ON m.article_id = l.l_orderkey"""

# Failed calls: exception name by event type, message with a status code.
ERRORS = """
SELECT event_id, event_type, k, k % 3 + 1 AS attempt,
  'https://news.example.com/events/' || CAST(event_id AS STRING) AS article_url,
  'Event ' || CAST(event_id AS STRING) || ' ' || event_type AS article_title,
  CASE event_type WHEN 'error' THEN 'ReadTimeout' WHEN 'click' THEN 'ConnectError'
       WHEN 'purchase' THEN 'HTTPStatusError' WHEN 'view' THEN 'ServiceUnavailable' ELSE 'ValueError' END AS error_type,
  CASE WHEN event_type = 'signup' AND k % 10 = 0 THEN 'read timeout while waiting'
       ELSE 'Server error ' || CAST(300 + k * 3 AS STRING) || ' for url' END AS error_message
FROM (SELECT *, """ + K + """ AS k FROM events) e"""

RUN_ID = "run_fixture"
RUN_WINDOW = ("2024-01-01", "2024-01-31")
# "Keyword" batches of the fixture: one per event type; the 'error' batch failed.
BATCHES = ["click", "error", "purchase", "signup", "view"]
FAILED_BATCHES = ["error"]

# Stored tables read by the lookback report.
REPORT_AS_OF, REPORT_DAYS = "2024-01-31 00:00:00", 7
REPORT_ARTICLES = """
SELECT event_id AS article_id, 'Event ' || CAST(event_id AS STRING) || ' ' || event_type AS title,
  'user' || CAST(user_id AS STRING) AS source_name, ts AS publish_datetime,
  'https://news.example.com/events/' || CAST(event_id AS STRING) AS url,
  event_type IN ('purchase', 'signup') AS mentions_cooling_or_water,
  CASE WHEN event_type = 'purchase' AND k % 2 = 0 THEN 'Water note ' || CAST(k AS STRING) END AS cooling_water_summary
FROM (SELECT *, """ + K + """ AS k FROM events) e"""
REPORT_FAILURES = "SELECT event_id AS failure_id, event_type AS stage, ts AS created_at FROM events"
REPORT_ARTICLE_PEOPLE = """
SELECT event_id AS article_id, user_id AS person_id,
       CASE WHEN value > 50 THEN 'Quoted' ELSE 'Mentioned' END AS role_in_article FROM events"""
REPORT_PEOPLE = """
SELECT c.c_custkey AS person_id, c.c_name AS full_name, CASE WHEN c.c_acctbal < 0 THEN NULL ELSE 'Buyer' END AS primary_title,
       n.n_name AS primary_company,
       CASE c.c_mktsegment WHEN 'BUILDING' THEN 'High' WHEN 'MACHINERY' THEN 'Medium' WHEN 'HOUSEHOLD' THEN NULL
            ELSE 'Low' END AS lead_relevance
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey"""
REPORT_FILES = {"Markdown": "reports/daily_report_20240131_000000.md",
                "Articles CSV": "reports/articles_20240131_000000.csv",
                "People CSV": "reports/people_20240131_000000.csv",
                "Failures CSV": "reports/failures_20240131_000000.csv"}
REPORT_PROJECT, REPORT_DATASET = "fixture-project", "fixture-dataset"

# One ingestion-state row per feed (user_id), derived from its events.
STATE_AS_OF = "2024-01-31 00:00:00"
STATE = """
SELECT CAST(user_id AS BIGINT) AS state_id,
  CAST(min(ts) AS DATE) AS backfill_start_date,
  CAST(max(ts) AS DATE) AS backfill_end_date,
  CASE WHEN user_id % 4 = 0 THEN NULL ELSE CAST(min(ts) AS DATE) + CAST(user_id % 40 AS INT) END AS backfill_progress_cutoff,
  user_id % 3 = 0 AS backfill_complete,
  CAST(NULL AS TIMESTAMP) AS last_daily_run_start,
  CASE WHEN user_id % 2 = 0 THEN CAST(CAST(min(ts) AS DATE) + CAST(user_id % 31 AS INT) AS TIMESTAMP)
                                 + INTERVAL 86399 SECOND END AS last_daily_run_end,
  CAST(NULL AS STRING) AS lock_owner, CAST(NULL AS TIMESTAMP) AS lock_expires_at,
  TIMESTAMP '2024-01-01 00:00:00' AS updated_at
FROM events GROUP BY user_id"""

# Model answers and failed extractions of pages, by canonical URL (``canonical_pages``: page_id, url), and the
# warehouse's column lengths: some companies and people don't fit.
_FIRST_PAGES = "SELECT url, min(page_id) AS page_id FROM canonical_pages GROUP BY url"
PAGE_ANSWERS = f"""
SELECT url, {EXTRACTION_ANSWER} AS answer
FROM (SELECT url, page_id AS event_id, page_id % 40 AS user_id, CAST(page_id % 100 AS INT) AS k,
        CASE WHEN page_id % 9 = 5 THEN 'a very long division of some other' ELSE 'kind' || CAST(page_id % 9 AS STRING) END
          AS event_type
      FROM ({_FIRST_PAGES}) f WHERE page_id % 5 <> 0) e"""
PAGE_ERRORS = f"""
SELECT url, 'ReadTimeout' AS error_type, 'no answer from ' || url AS error_message
FROM ({_FIRST_PAGES}) f WHERE page_id % 11 = 3"""
COLUMN_LIMITS = {"companies": {"name": 32}, "people": {"primary_company": 32}}
