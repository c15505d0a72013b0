"""The queries of the catalog as plain SQL over the same input tables, for comparison.

Written step by step with one CTE per model and ordinary joins, without the shortcuts the
Spark plans take (bounded scans, one-pass aggregates, join-free scores).
"""

from __future__ import annotations

# --- shared steps -----------------------------------------------------------------------

MODELS = """
WITH src_customers AS (
  SELECT c_custkey AS customer_id, replace(c_name, '#', '.') || '@example.com' AS email,
         'C' || c_custkey AS first_name, c_mktsegment AS last_name,
         DATE '2017-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS created_at, n_name AS country,
         CAST(CASE WHEN c_acctbal > 0 THEN 1 END AS INTEGER) AS marketing_opt_in,
         CASE WHEN c_custkey % 13 <> 0 THEN CAST(c_custkey % 11 AS DOUBLE) END AS nps_score
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
),
src_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CAST(o_orderdate + INTERVAL 8217 DAY AS TIMESTAMP) AS order_ts,
         CASE o_orderstatus WHEN 'P' THEN 'refunded' ELSE 'paid' END AS status,
         floor(o_totalprice / 10) / 100.0 AS amount
  FROM orders
),
src_events AS (
  SELECT event_id, user_id AS customer_id, event_type, ts AS event_ts,
         's' || user_id || '-' || CAST(ts AS DATE) AS session_id
  FROM events
),
src_spend AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         CASE l_returnflag WHEN 'A' THEN 'search' WHEN 'R' THEN 'social' ELSE 'email' END AS channel,
         'c' || (l_suppkey % 20) AS campaign,
         floor(l_extendedprice * l_discount * 100) / 100.0 AS spend
  FROM lineitem
),
cust AS (
  SELECT customer_id, lower(email) AS email, first_name, last_name, created_at, country,
         coalesce(marketing_opt_in, 0) AS marketing_opt_in,
         CAST(round_even(nps_score, 0) AS INTEGER) AS nps_score
  FROM src_customers
),
order_facts AS (SELECT *, CAST(date_trunc('week', order_ts) AS TIMESTAMP) AS order_week FROM src_orders),
event_facts AS (
  SELECT event_id, customer_id, event_type, event_ts,
         CAST(date_trunc('week', event_ts) AS TIMESTAMP) AS event_week
  FROM src_events
),
money AS (SELECT *, CAST(CAST(amount AS VARCHAR) AS DECIMAL(38, 16)) AS exact FROM order_facts),
all_orders AS (SELECT customer_id, count(*) AS n FROM order_facts GROUP BY customer_id),
paid_ever AS (
  SELECT customer_id, CAST(sum(exact) AS DOUBLE) AS total
  FROM money WHERE status = 'paid' GROUP BY customer_id
),
paid_12wk AS (
  SELECT customer_id, CAST(sum(exact) AS DOUBLE) AS total FROM money
  WHERE status = 'paid' AND order_ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 12 WEEK
  GROUP BY customer_id
),
paid_90d AS (
  SELECT customer_id, CAST(sum(exact) AS DOUBLE) AS total FROM money
  WHERE status = 'paid' AND order_ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 90 DAY
  GROUP BY customer_id
),
last_seen AS (SELECT customer_id, max(event_ts) AS ts FROM event_facts GROUP BY customer_id),
active_30d AS (
  SELECT customer_id, count(*) AS n FROM event_facts
  WHERE event_ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 30 DAY
  GROUP BY customer_id
),
profile AS (
  SELECT cust.*, coalesce(all_orders.n, 0) AS orders_cnt,
         coalesce(paid_ever.total, 0.0::DOUBLE) AS lifetime_revenue, last_seen.ts AS last_event_ts,
         coalesce(paid_12wk.total, 0.0::DOUBLE) AS revenue_12wk,
         coalesce(paid_90d.total, 0.0::DOUBLE) AS revenue_90d, coalesce(active_30d.n, 0) AS events_30d
  FROM cust
  LEFT JOIN all_orders USING (customer_id)
  LEFT JOIN paid_ever USING (customer_id)
  LEFT JOIN last_seen USING (customer_id)
  LEFT JOIN paid_12wk USING (customer_id)
  LEFT JOIN paid_90d USING (customer_id)
  LEFT JOIN active_30d USING (customer_id)
),
scores AS (
  SELECT customer_id, email,
         CASE WHEN events_30d = 0 AND revenue_90d >= 150 THEN 'high_value_lapse_risk'
              WHEN events_30d >= 2 AND revenue_90d = 0 THEN 'new_users_first_week_intent'
              WHEN nps_score < 7 THEN 'churn_rescue_nps'
              ELSE 'unclassified' END AS segment,
         revenue_90d * 0.6 + events_30d * 5 + CASE WHEN nps_score < 7 THEN 20 ELSE 0 END AS score
  FROM profile
),
records AS (
  SELECT s.customer_id, s.email, s.segment, s.score,
         coalesce(nullif(p.first_name, ''), 'valued customer') AS first_name, p.nps_score, p.events_30d,
         p.orders_cnt, p.lifetime_revenue, coalesce(CAST(p.created_at AS VARCHAR), 'N/A') AS created_at,
         coalesce(CASE WHEN microsecond(p.last_event_ts) % 1000000 = 0
                       THEN strftime(p.last_event_ts, '%Y-%m-%d %H:%M:%S')
                       ELSE strftime(p.last_event_ts, '%Y-%m-%d %H:%M:%S.%f') END, 'N/A') AS last_event_ts,
         coalesce(nullif(p.country, ''), 'Unknown') AS country
  FROM scores s LEFT JOIN profile p ON p.customer_id = s.customer_id
  WHERE s.segment IN ('high_value_lapse_risk', 'new_users_first_week_intent', 'churn_rescue_nps')
),
action_rules(segment, channel, template, discount) AS (
  VALUES ('high_value_lapse_risk', 'email', 'winback_soft', 5.0::DOUBLE),
         ('new_users_first_week_intent', 'email', 'onboarding_tips', 0.0::DOUBLE),
         ('churn_rescue_nps', 'cs_ticket', 'nps_followup_then_offer', 10.0::DOUBLE)
),
payload AS (
  SELECT r.*, a.channel, a.template, a.discount,
         '{"channel": "' || a.channel || '", "template": "' || a.template || '", "discount_pct": '
           || CAST(a.discount AS VARCHAR) || '}' AS nba_action
  FROM records r JOIN action_rules a USING (segment)
),
risks AS (
  SELECT customer_id,
         CASE WHEN nps_score IS NULL THEN NULL ELSE
           least(1.0::DOUBLE, greatest(0.0::DOUBLE,
             (greatest(0.0::DOUBLE, CAST(7 - nps_score AS DOUBLE) / 7) * 0.4::DOUBLE
              + (CASE WHEN events_30d = 0 THEN 1.0::DOUBLE ELSE 0.3::DOUBLE END) * 0.6::DOUBLE)
             * least(1.0::DOUBLE, lifetime_revenue / 500)))
         END AS risk
  FROM profile
),
texts AS (
  SELECT p.customer_id,
         CASE p.segment
           WHEN 'high_value_lapse_risk' THEN 'Hi ' || first_name
             || ', we miss you! Here''s 5.0% off your next order to welcome you back.'
           WHEN 'new_users_first_week_intent' THEN 'Welcome ' || first_name
             || '! Here are some tips to get the most out of your experience with us.'
           WHEN 'churn_rescue_nps' THEN 'Hi ' || first_name
             || ', thanks for your feedback. Let''s make this right with a 10.0% discount on us.'
           ELSE 'Hi ' || first_name || ', we have something special for you!' END AS message
  FROM (SELECT s.customer_id, s.segment, c.first_name FROM scores s JOIN cust c USING (customer_id)) p
),
"""

RECORDS = """
forms AS (
  SELECT *, CASE WHEN nps_score < 7 THEN 'churn_rescue_nps' WHEN marketing_opt_in = 1
                 THEN 'high_value_lapse_risk' ELSE 'new_users_first_week_intent' END AS target
  FROM cust
),
entries AS (
  SELECT customer_id AS number, 'manual-' || customer_id AS customer_id, email,
         CASE WHEN number % 7 = 0 THEN target ELSE first_name END AS first_name,
         first_name || ' Company' AS company,
         CASE WHEN number % 7 = 0 THEN first_name WHEN number % 23 = 1 THEN '0.75' ELSE target END AS segment,
         CASE WHEN number % 5 = 0 THEN CAST(number % 101 AS VARCHAR) WHEN number % 17 = 0 THEN NULL
              ELSE '0.' || (number % 10) END AS score,
         CAST(nps_score AS VARCHAR) AS nps_score, '0' AS events_30d, '0' AS orders_cnt,
         '0.0' AS lifetime_revenue,
         CASE number % 11 WHEN 0 THEN 'not a date' WHEN 1 THEN '12/25/2023' ELSE '2024-01-01' END AS created_at,
         '2024-01-31' AS last_event_ts, country,
         CASE number % 3
           WHEN 0 THEN '{"channel": "email", "template": "promotional", "discount_pct": 0.0}'
           WHEN 1 THEN '{''channel'': ''email'', ''template'': ''promotional'', ''discount_pct'': 0.0}'
           ELSE 'oops' END AS nba_action
  FROM (SELECT forms.customer_id AS number, * FROM forms)
),
requoted AS (
  SELECT number, regexp_replace(regexp_replace(nba_action, '''([^'']*)'':', '"\\1":', 'g'),
                                ': ''([^'']*)''', ': "\\1"', 'g') AS text
  FROM entries
),
fixed AS (
  SELECT e.number, e.customer_id, e.email,
         CASE WHEN e.number % 7 = 0 THEN e.segment ELSE e.first_name END AS first_name, e.company,
         CASE WHEN e.number % 7 = 0 THEN e.first_name ELSE e.segment END AS segment,
         CASE WHEN CAST(e.score AS DOUBLE) BETWEEN 0 AND 1 THEN CAST(e.score AS DOUBLE)
              WHEN CAST(e.score AS DOUBLE) > 1 THEN CAST(e.score AS DOUBLE) / 100
              ELSE 0.5::DOUBLE END AS score,
         e.nps_score, e.events_30d, e.orders_cnt, e.lifetime_revenue,
         strftime(coalesce(try_cast(e.created_at AS DATE),
                           CAST(try_strptime(e.created_at, '%m/%d/%Y') AS DATE)), '%Y-%m-%d') AS created_at,
         e.last_event_ts, e.country,
         CASE WHEN json_valid(e.nba_action) THEN e.nba_action WHEN json_valid(q.text) THEN q.text
              ELSE e.nba_action END AS nba_action
  FROM entries e JOIN requoted q ON q.number = e.number
),
sent AS (
  SELECT 'manual-' || customer_id AS customer_id, NULL::VARCHAR AS email, 'churn_rescue_nps' AS segment,
         0.5::DOUBLE AS score, first_name, NULL::VARCHAR AS nba_action, 'machinery_payload' AS source,
         'machinery' AS run_id
  FROM cust WHERE last_name = 'MACHINERY'
  UNION ALL
  SELECT NULL, email, 'churn_rescue_nps', 0.5, first_name, NULL, 'furniture_payload', 'furniture'
  FROM cust WHERE last_name = 'FURNITURE'
),
ledger AS (
  SELECT customer_id, email, first_name, company, segment, score, nps_score, events_30d, orders_cnt,
         lifetime_revenue, created_at, last_event_ts, country, nba_action,
         'manual_entries.csv' AS source, NULL::VARCHAR AS run_id, NULL::VARCHAR AS salesforce_status
  FROM entries
  UNION ALL
  SELECT customer_id, email, first_name, NULL, segment, CAST(score AS VARCHAR), NULL, NULL, NULL, NULL, NULL,
         NULL, NULL, nba_action, source, run_id, 'Sent to Salesforce'
  FROM sent
),
marks AS (
  SELECT e.customer_id, e.email, e.first_name,
         e.customer_id IN (SELECT customer_id FROM sent WHERE customer_id IS NOT NULL) AS is_sent
  FROM entries e
),
keys AS (
  SELECT DISTINCT CASE last_name WHEN 'HOUSEHOLD' THEN 'manual-' || customer_id
                                 WHEN 'BUILDING' THEN upper(email)
                                 ELSE 'nobody-' || customer_id END AS lookup
  FROM cust
),
delivered AS (
  SELECT customer_id AS number, segment, score, template,
         CASE number % 7 WHEN 2 THEN email WHEN 4 THEN 'unknown' ELSE CAST(number AS VARCHAR) END AS customer_id,
         CASE number % 7 WHEN 1 THEN email WHEN 3 THEN '0.75' WHEN 5 THEN '42' ELSE first_name END AS first_name,
         CASE number % 7 WHEN 1 THEN first_name WHEN 2 THEN 'n/a' WHEN 5 THEN 'n/a' ELSE email END AS email
  FROM (SELECT payload.customer_id AS number, * FROM payload)
),
contacts AS (
  SELECT number,
         CASE number % 7 WHEN 2 THEN 'manual-' || substr(sha256(p.email), 1, 16)
                         WHEN 4 THEN 'manual-' || substr(sha256(p.email), 1, 16)
                         ELSE CAST(number AS VARCHAR) END AS customer_id,
         CASE number % 7 WHEN 3 THEN upper(p.email[1]) || lower(split_part(substr(p.email, 2), '@', 1))
                         WHEN 5 THEN '42' ELSE p.first_name END AS first_name,
         CASE number % 7 WHEN 5 THEN 'n/a' ELSE p.email END AS email
  FROM (SELECT payload.customer_id AS number, * FROM payload) p
)
"""


def _all(table: str, columns: str = "*") -> str:
    return f"SELECT {columns} FROM {table}"


PAYLOAD_COLUMNS = "* EXCLUDE (channel, template, discount)"
SHOWN = "customer_id, email, first_name, segment, score, source, salesforce_status"

_CORE = {
    "scan_customers": _all("src_customers"),
    "scan_orders": _all("src_orders"),
    "scan_web_events": _all("src_events"),
    "scan_ad_spend": _all("src_spend"),
    "stg_customers": _all("cust"),
    "stg_orders": _all("src_orders"),
    "stg_web_events": _all("src_events"),
    "stg_ad_spend": _all("src_spend"),
    "fct_orders": _all("order_facts"),
    "fct_events": _all("event_facts"),
    "dim_customer": _all("profile", "* EXCLUDE (revenue_12wk, revenue_90d, events_30d)"),
    "customer_360": _all("profile"),
    "segment_scores": _all("scores"),
    "lookback_revenue": """
        SELECT d.customer_id, w.total AS revenue_12wk, d.total AS revenue_90d
        FROM paid_90d d LEFT JOIN paid_12wk w USING (customer_id)""",
    "first_order": """
        SELECT customer_id, min(order_ts) AS first_order_ts FROM order_facts
        WHERE status = 'paid' GROUP BY customer_id""",
    "cohort_retention": """
        SELECT c.cohort_week, f.order_week, count(DISTINCT f.customer_id) AS active_customers
        FROM (SELECT customer_id, CAST(date_trunc('week', min(order_ts)) AS TIMESTAMP) AS cohort_week
              FROM order_facts WHERE status = 'paid' GROUP BY customer_id) c
        JOIN order_facts f ON f.customer_id = c.customer_id
        WHERE f.status = 'paid' GROUP BY ALL""",
    "rolling_count": """
        SELECT event_type,
               CAST(sum(CAST(event_ts >= TIMESTAMP '2024-01-01 00:00:00' AS INTEGER)) AS BIGINT) AS events_30d,
               CAST(sum(CAST(event_ts >= TIMESTAMP '2024-01-24 00:00:00' AS INTEGER)) AS BIGINT) AS events_7d
        FROM event_facts GROUP BY event_type""",
    "materialize_marts": """
        SELECT 'stg_customers' AS model, count(*) AS rows FROM cust
        UNION ALL SELECT 'stg_ad_spend', count(*) FROM src_spend
        UNION ALL SELECT 'fct_orders', count(*) FROM order_facts
        UNION ALL SELECT 'fct_events', count(*) FROM event_facts
        UNION ALL SELECT 'customer_360', count(*) FROM profile
        UNION ALL SELECT 'dim_customer', count(*) FROM profile
        UNION ALL SELECT 'segment_scores', count(*) FROM scores
        UNION ALL SELECT 'cohort_retention', count(*) FROM (
          SELECT DISTINCT min(order_week) OVER (PARTITION BY customer_id), order_week
          FROM order_facts WHERE status = 'paid')""",
    "kpi_by_filter": """
        SELECT country_filter, count(*) AS total_customers,
               CAST(sum(CAST(CAST(lifetime_revenue AS VARCHAR) AS DECIMAL(38, 16))) AS DOUBLE) AS total_revenue,
               CAST(sum(nps_score) AS DOUBLE) / count(nps_score) AS avg_nps,
               count(*) FILTER (WHERE events_30d > 0) AS active_customers
        FROM (SELECT *, 'All' AS country_filter FROM profile UNION ALL SELECT *, country FROM profile)
        WHERE country_filter IS NOT NULL GROUP BY country_filter""",
    "kpi_display": """
        SELECT country_filter, format('{:,}', count(*)) AS total_customers,
               '$' || format('{:,}', CAST(round_even(CAST(sum(CAST(CAST(lifetime_revenue AS VARCHAR) AS DECIMAL(38, 16))) AS DOUBLE), 0) AS BIGINT)) AS total_revenue,
               printf('%.1f', CAST(sum(nps_score) AS DOUBLE) / count(nps_score)) AS avg_nps,
               format('{:,}', count(*) FILTER (WHERE events_30d > 0)) AS active_customers
        FROM (SELECT *, 'All' AS country_filter FROM profile UNION ALL SELECT *, country FROM profile)
        WHERE country_filter IS NOT NULL GROUP BY country_filter""",
    "hist_revenue": """
        SELECT bin, min(lo) + bin * min(width) AS bin_start, count(*) AS customers
        FROM (SELECT lo, width, CAST(least(floor((lifetime_revenue - lo) / width), 19) AS BIGINT) AS bin
              FROM (SELECT lifetime_revenue, min(lifetime_revenue) OVER () AS lo,
                           (max(lifetime_revenue) OVER () - min(lifetime_revenue) OVER ()) / 20 AS width
                    FROM profile))
        GROUP BY bin""",
    "hist_nps": """
        SELECT bin, min(lo) + bin * min(width) AS bin_start, count(*) AS customers
        FROM (SELECT lo, width, CAST(least(floor((x - lo) / width), 9) AS BIGINT) AS bin
              FROM (SELECT x, min(x) OVER () AS lo, (max(x) OVER () - min(x) OVER ()) / 10 AS width
                    FROM (SELECT CAST(nps_score AS DOUBLE) AS x FROM profile WHERE nps_score IS NOT NULL)))
        GROUP BY bin""",
    "revenue_by_country": """
        SELECT country, CAST(sum(CAST(CAST(lifetime_revenue AS VARCHAR) AS DECIMAL(38, 16))) AS DOUBLE)
                 AS lifetime_revenue
        FROM profile WHERE country IS NOT NULL GROUP BY country""",
    "segment_counts": "SELECT segment, count(*) AS customers FROM scores GROUP BY segment",
    "nps_categories": """
        SELECT CASE WHEN nps_score >= 9 THEN 'Promoters' WHEN nps_score >= 7 THEN 'Passives'
                    ELSE 'Detractors' END AS category, count(*) AS customers
        FROM profile GROUP BY category""",
    "recent_activity": """
        SELECT customer_id, email, country, events_30d, orders_cnt, lifetime_revenue, nps_score
        FROM profile WHERE events_30d > 0""",
    "top_active": """
        SELECT customer_id, email, events_30d, lifetime_revenue FROM profile WHERE events_30d > 0
        ORDER BY events_30d DESC, customer_id LIMIT 5""",
    "filter_values": """
        SELECT DISTINCT 'country' AS filter, country AS value FROM profile
        UNION ALL SELECT DISTINCT 'segment', segment FROM scores""",
    "segment_context": "SELECT * FROM records WHERE segment = 'churn_rescue_nps'",
    "segment_context_all": _all("records"),
    "first_n_segment": """
        SELECT * FROM records WHERE segment = 'high_value_lapse_risk' ORDER BY score DESC, customer_id LIMIT 2""",
    "next_best_action": """
        SELECT s.customer_id, s.segment, coalesce(a.channel, 'none') AS channel,
               coalesce(a.template, 'holdout') AS template,
               least(coalesce(a.discount, 0.0::DOUBLE), 7.0::DOUBLE) AS discount_pct
        FROM scores s LEFT JOIN action_rules a ON a.segment = s.segment""",
    "rule_risk": _all("risks"),
    "template_message": _all("texts"),
    "activation_payload": _all("payload", PAYLOAD_COLUMNS),
    "payload_roundtrip": _all("payload", PAYLOAD_COLUMNS),
    "nba_flat": """
        SELECT customer_id, email, segment, score, channel AS "Channel", template AS "Template",
               CAST(discount AS VARCHAR) || '%' AS "Discount"
        FROM payload""",
    "risk_display": """
        SELECT customer_id, email, segment, coalesce(printf('%.3f', risk), 'N/A') AS "LLM_Risk"
        FROM records JOIN risks USING (customer_id)""",
    "messages": """
        SELECT customer_id, email, segment, message AS personalized_message
        FROM payload JOIN texts USING (customer_id) WHERE discount > 0""",
    "activation_summary": """
        SELECT segment AS line, count(*) AS customers FROM payload GROUP BY segment
        UNION ALL SELECT 'Customers Activated', count(*) FROM payload""",
    "activation_metrics": """
        SELECT count(*) AS customers_activated, count(DISTINCT segment) AS segments_targeted,
               CAST(sum(CAST(CAST(risk AS VARCHAR) AS DECIMAL(38, 16))) AS DOUBLE) / count(risk) AS avg_risk
        FROM records JOIN risks USING (customer_id)""",
    "validate_activation": """
        SELECT count(*) AS activated,
               CAST(sum(CAST(CAST(risk AS VARCHAR) AS DECIMAL(38, 16))) AS DOUBLE) / count(risk) AS avg_risk
        FROM records JOIN risks USING (customer_id)""",
    "model_risk": """
        SELECT customer_id,
               CASE WHEN nps_score IS NULL OR nps_score = 0 THEN risk WHEN nps_score = 10 THEN 1.0::DOUBLE
                    ELSE CAST('0.' || nps_score || '5' AS DOUBLE) END AS llm_risk_score
        FROM records JOIN risks USING (customer_id)""",
    "model_message": """
        SELECT customer_id, CASE WHEN nps_score IS NULL THEN message
               ELSE 'Dear ' || first_name || ', we would like to hear from you.' END AS personalized_message
        FROM records JOIN texts USING (customer_id)""",
    "model_sentiment": """
        SELECT customer_id,
               CASE WHEN nps_score >= 7 THEN 'positive' WHEN nps_score < 7 THEN 'negative'
                    ELSE 'neutral' END AS sentiment,
               coalesce('nps ' || nps_score || '; known', 'Analysis unavailable') AS key_insights,
               CASE WHEN nps_score IS NULL THEN 'Standard follow-up recommended' ELSE 'call' END
                 AS recommended_action
        FROM records""",
    "followup_steps": """
        SELECT customer_id, segment,
               CASE segment
                 WHEN 'high_value_lapse_risk' THEN 'Created high-priority opportunity; Assigned to account manager'
                 WHEN 'churn_rescue_nps'
                   THEN 'Created support case for follow-up; Triggered customer success workflow'
                 ELSE 'Updated lead score and priority' END
                 || '; Created task: Follow up on ' || template AS steps
        FROM payload""",
}
_CORE["segment_context_join"] = _CORE["segment_context_all"]
_CORE["segment_performance"] = _CORE["segment_performance_join"] = """
    SELECT segment,
           CAST(sum(CAST(CAST(lifetime_revenue AS VARCHAR) AS DECIMAL(38, 16))) AS DOUBLE)
             / count(lifetime_revenue) AS lifetime_revenue,
           CAST(sum(nps_score) AS DOUBLE) / count(nps_score) AS nps_score,
           CAST(sum(CAST(CAST(score AS VARCHAR) AS DECIMAL(38, 16))) AS DOUBLE) / count(score) AS score
    FROM scores JOIN profile USING (customer_id) GROUP BY segment"""


def _test(test: str, model: str, column: str, count: str) -> str:
    names = f"'{test}' AS test, '{model}' AS model, '{column}' AS column_name"
    return f"SELECT {names}, failures, failures = 0 AS passed FROM ({count})"


def _not_null(model: str, table: str, column: str) -> str:
    return _test("not_null", model, column, f"SELECT count(*) AS failures FROM {table} WHERE {column} IS NULL")


def _unique(model: str, table: str, column: str) -> str:
    repeated = f"SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1"
    return _test("unique", model, column, f"SELECT count(*) AS failures FROM ({repeated})")


def _accepted(model: str, table: str, column: str, values: str) -> str:
    count = f"SELECT count(DISTINCT {column}) AS failures FROM {table} WHERE {column} NOT IN ({values})"
    return _test("accepted_values", model, column, count)


_TESTS = {
    "dq_not_null": [
        _not_null("stg_customers", "cust", "customer_id"),
        _not_null("stg_customers", "cust", "email"),
        _not_null("dim_customer", "profile", "customer_id"),
        _not_null("fct_orders", "order_facts", "order_id"),
    ],
    "dq_unique": [
        _unique("stg_customers", "cust", "customer_id"),
        _unique("dim_customer", "profile", "customer_id"),
        _unique("fct_orders", "order_facts", "order_id"),
    ],
    "dq_accepted_values": [
        _accepted("fct_orders", "order_facts", "status", "'paid', 'refunded'"),
        _accepted(
            "segment_scores",
            "scores",
            "segment",
            "'high_value_lapse_risk', 'new_users_first_week_intent', 'churn_rescue_nps', 'unclassified'",
        ),
    ],
}
_TESTS["dq_report"] = [line for lines in list(_TESTS.values()) for line in lines]
for _name, _lines in _TESTS.items():
    _CORE[_name] = "\nUNION ALL ".join(_lines)

_OUTREACH = {
    "lead_rows": """
        SELECT customer_id, first_name AS "FirstName", first_name AS "LastName", email AS "Email",
               first_name || ' Company' AS "Company", 'Customer' AS "Title",
               'Customer Activation Platform' AS "LeadSource", 'Open - Not Contacted' AS "Status"
        FROM contacts""",
    "task_rows": """
        SELECT c.customer_id,
               CASE d.segment
                 WHEN 'high_value_lapse_risk' THEN 'High-value customer at risk - Immediate follow-up'
                 WHEN 'new_users_first_week_intent' THEN 'New user onboarding - Follow up on initial experience'
                 ELSE 'Customer satisfaction issue - Urgent outreach needed' END AS "Subject",
               'SF-' || c.customer_id AS "WhoId", 'Not Started' AS "Status", 'High' AS "Priority",
               'Follow up with '
                 || CASE number % 7 WHEN 5 THEN 'Customer' WHEN 3 THEN c.first_name ELSE d.first_name END
                 || ' regarding ' || d.template || '. Customer score: ' || CAST(d.score AS VARCHAR)
                 || '. Segment: ' || d.segment || '.' AS "Description"
        FROM delivered d JOIN contacts c USING (number)""",
    "delivery_log": """
        SELECT c.customer_id,
               CASE WHEN contains(c.email, '@') THEN 'Lead:' || split_part(c.email, '@', 1)
                    ELSE 'SF-' || c.customer_id END AS lead_id,
               contains(c.email, '@') AND d.segment <> 'churn_rescue_nps' AS task_created
        FROM delivered d JOIN contacts c USING (number)""",
    "direct_submission": """
        SELECT customer_id, email, first_name, company, segment, score, CAST(nps_score AS INTEGER) AS nps_score,
               CAST(events_30d AS BIGINT) AS events_30d, CAST(orders_cnt AS BIGINT) AS orders_cnt,
               CAST(lifetime_revenue AS DOUBLE) AS lifetime_revenue, created_at, last_event_ts, country,
               CASE WHEN json_valid(nba_action) THEN nba_action END AS nba_action,
               CASE WHEN nps_score IS NOT NULL THEN 0.0::DOUBLE END AS llm_risk_score,
               '2024-01-31 00:00:00' AS _sent_to_salesforce_at
        FROM entries""",
    "payload_files": """
        SELECT CAST(customer_id AS VARCHAR) AS customer_id, email, segment, '  ' || first_name || ' ' AS first_name,
               CAST(NULL AS VARCHAR) AS note, 'lapse_payload.csv' AS source
        FROM records WHERE segment = 'high_value_lapse_risk'
        UNION ALL
        SELECT CAST(customer_id AS VARCHAR), email, segment, first_name,
               'said "hi",' || chr(10) || ' bye', 'rescue_payload.csv'
        FROM records WHERE segment = 'churn_rescue_nps'""",
    "rejected_files": "SELECT 'damaged_payload.csv.gz' AS file, true AS has_reason",
    "manual_files": """
        SELECT * EXCLUDE (number), 'backup' AS version FROM entries
        UNION ALL BY NAME
        SELECT * EXCLUDE (number) REPLACE (CAST(score AS VARCHAR) AS score), 'repaired' AS version FROM fixed""",
    "delivered_ledger": """
        SELECT CAST(d.customer_id AS VARCHAR) AS customer_id, d.email, d.segment
        FROM delivered d JOIN contacts c USING (number)
        WHERE contains(c.email, '@') AND d.segment <> 'churn_rescue_nps'""",
    "manual_entries": _all("entries", "* EXCLUDE (number)"),
    "misalign_flag": """
        SELECT bool_or(first_name IN ('high_value_lapse_risk', 'new_users_first_week_intent', 'churn_rescue_nps')
                       OR try_cast(segment AS DOUBLE) IS NOT NULL) AS misaligned
        FROM entries""",
    "repair_manual": _all("fixed", "* EXCLUDE (number)"),
    "repair_json": _all("fixed", "customer_id, nba_action"),
    "normalize_score": _all("fixed", "customer_id, score"),
    "normalize_dates": _all("fixed", "customer_id, created_at, last_event_ts"),
    "manual_activation": """
        SELECT e.* EXCLUDE (number, nba_action),
               '{"channel": "' || coalesce(a.channel, 'none') || '", "template": "' || coalesce(a.template, 'holdout')
                 || '", "discount_pct": ' || CAST(coalesce(a.discount, 0.0) AS VARCHAR) || '}' AS nba_action
        FROM entries e LEFT JOIN action_rules a ON a.segment = e.segment""",
    "sent_ledger": _all("sent"),
    "sent_keys": """
        SELECT DISTINCT 'id' AS kind, customer_id AS key FROM sent WHERE customer_id IS NOT NULL
        UNION ALL SELECT DISTINCT 'email', email FROM sent WHERE email IS NOT NULL""",
    "unsent_by_id": """
        SELECT * EXCLUDE (number) FROM entries e
        WHERE NOT EXISTS (SELECT 1 FROM sent s WHERE s.customer_id = e.customer_id)""",
    "unsent_by_id_email": """
        SELECT * EXCLUDE (number) FROM entries e
        WHERE NOT EXISTS (SELECT 1 FROM sent s WHERE s.customer_id = e.customer_id)
          AND NOT EXISTS (SELECT 1 FROM sent s WHERE s.email = e.email)""",
    "sent_status": """
        SELECT customer_id, email, first_name,
               CASE WHEN is_sent THEN 'Sent to Salesforce' ELSE 'Not sent' END AS salesforce_status
        FROM marks""",
    "sync_report": """
        SELECT count(*) AS total_records, count(*) FILTER (WHERE is_sent) AS sent_records,
               count(*) FILTER (WHERE NOT is_sent) AS unsent_records
        FROM marks""",
    "ledger_union": _all("ledger"),
    "ledger_lookup": _all("ledger", SHOWN),
    "ledger_search": f"SELECT {SHOWN} FROM ledger WHERE email ILIKE '%c1%' OR first_name ILIKE '%c1%'",
    "record_detail": f"""
        SELECT {SHOWN} FROM ledger WHERE customer_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY source, email NULLS FIRST) = 1""",
    "find_customer": """
        SELECT lookup, 'id' AS found_by, customer_id, email FROM entries JOIN keys ON customer_id = lookup
        UNION ALL
        SELECT lookup, 'email', customer_id, email FROM entries JOIN keys ON lower(email) = lower(lookup)
        WHERE lookup NOT IN (SELECT customer_id FROM entries)""",
    "stream_sync": """
        SELECT customer_id, email, segment, score, first_name, nba_action FROM fixed f
        WHERE NOT EXISTS (SELECT 1 FROM sent s WHERE s.customer_id = f.customer_id)
          AND NOT EXISTS (SELECT 1 FROM sent s WHERE s.email = f.email)""",
}
_OUTREACH["unsent_by_key_index"] = _OUTREACH["payload_ledger"] = _OUTREACH["unsent_by_id_email"]


def statements() -> dict[str, str]:
    steps = MODELS.rstrip().rstrip(",")
    core = {name: f"{steps}\n{select.strip()}" for name, select in _CORE.items()}
    outreach = {name: f"{MODELS.rstrip()}{RECORDS.rstrip()}\n{select.strip()}" for name, select in _OUTREACH.items()}
    return {**core, **outreach}
