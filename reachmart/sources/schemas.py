"""Column lists and read schemas of the tables and files."""

SEED_SCHEMAS = {
    "customers": (
        "customer_id bigint, email string, first_name string, last_name string, created_at date, "
        "country string, marketing_opt_in int, nps_score double"
    ),
    "orders": "order_id bigint, customer_id bigint, order_ts timestamp_ntz, status string, amount double",
    "web_events": (
        "event_id bigint, customer_id bigint, event_type string, event_ts timestamp_ntz, session_id string"
    ),
    "ad_spend": "date date, channel string, campaign string, spend double",
}

# The columns read from the sales tables. A declared schema spares a job per table that
# would look it up in the files.
SALES_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
    "lineitem": (
        "l_suppkey bigint, l_extendedprice double, l_discount double, l_returnflag string, l_shipdate timestamp_ntz"
    ),
}

CUSTOMER_COLUMNS = [
    "customer_id", "email", "first_name", "last_name", "created_at", "country", "marketing_opt_in", "nps_score",
]
DIM_COLUMNS = [*CUSTOMER_COLUMNS, "orders_cnt", "lifetime_revenue", "last_event_ts"]
PROFILE_COLUMNS = [*DIM_COLUMNS, "revenue_12wk", "revenue_90d", "events_30d"]

RECORD_COLUMNS = [
    "customer_id", "email", "segment", "score", "first_name", "nps_score", "events_30d", "orders_cnt",
    "lifetime_revenue", "created_at", "last_event_ts", "country",
]

MANUAL_COLUMNS = [
    "customer_id", "email", "first_name", "company", "segment", "score", "nps_score", "events_30d", "orders_cnt",
    "lifetime_revenue", "created_at", "last_event_ts", "country", "nba_action",
]
# Hand-entered files are read as text; the repair job types them.
MANUAL_SCHEMA = ", ".join(f"{name} string" for name in MANUAL_COLUMNS)
