"""The logical tables, derived from the TPC-H-like sample data.

Each table is one SQL text that Spark and DuckDB both run, so an oracle can start from the
very same rows. Odd constants plant dirty values on purpose: bad dates, blank e-mails, an end
before the start, ids under several names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PLANS = """
SELECT CAST(plan_id AS INT) AS plan_id, plan_name, plan_tier,
       CAST(monthly AS DECIMAL(18,2)) AS monthly_price_usd,
       CAST(annual AS DECIMAL(18,2)) AS annual_price_usd
FROM (VALUES (1, 'Free', 'free', 0, 0), (2, 'Starter', 'starter', 29, 290),
             (3, 'Pro', 'professional', 99, 990), (4, 'Business', 'enterprise', 299, 2990),
             (5, 'Scale', 'enterprise', 499, 4990))
     AS p(plan_id, plan_name, plan_tier, monthly, annual)
"""

SUBSCRIPTIONS = """
SELECT o_orderkey AS subscription_id, o_custkey AS customer_id,
       6 - CAST(substring(o_orderpriority, 1, 1) AS INT) AS plan_id,
       CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'cancelled' ELSE 'trial' END
         AS status,
       CASE WHEN o_orderkey % 2 = 0 THEN 'monthly' ELSE 'annual' END AS billing_cycle,
       CAST(o_orderdate AS DATE) AS start_date,
       CASE WHEN o_orderstatus <> 'F' THEN NULL
            WHEN o_orderkey % 97 = 0 THEN CAST(o_orderdate AS DATE) - 5
            ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 365 AS INT) END AS end_date,
       CASE WHEN o_orderkey % 101 = 0 THEN -1.0E0 ELSE o_totalprice / 1000 END AS mrr_usd,
       CAST(NULL AS DOUBLE) AS discount_pct, CAST(NULL AS DATE) AS trial_end_date,
       CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 <> 0 THEN 'price' END
         AS cancellation_reason
FROM {orders}
"""

CUSTOMERS = """
SELECT c_custkey AS customer_id,
       concat('Org ', c_mktsegment, ' ', CAST(c_nationkey AS STRING), ' ',
              chr(CAST(97 + c_custkey % 26 AS INT)),
              CASE WHEN c_custkey % 9 = 0 THEN ' Ltd' ELSE '' END) AS company_name,
       c_mktsegment AS industry, CAST(NULL AS STRING) AS company_size,
       CAST(NULL AS STRING) AS country_code, n_name AS country_name,
       CAST(NULL AS STRING) AS timezone,
       CASE c_custkey % 50 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'no-at-sign'
            ELSE concat(' U', CAST(c_custkey AS STRING), '@D',
                        CAST(c_custkey % 300 AS STRING), '.com ') END AS contact_email,
       CASE WHEN c_custkey % 40 = 0 THEN 'bad-date' ELSE '1995-01-01' END AS signup_date,
       CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE c_custkey % 4 <> 0 END AS is_active,
       CAST(NULL AS {naive}) AS churned_at, CAST(NULL AS STRING) AS churn_reason,
       CASE WHEN c_custkey % 6 <> 0 THEN CAST(c_custkey % 13 - 1 AS INT) END AS nps_score
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""

SUPPORT_TICKETS = """
SELECT l_orderkey * 10 + l_linenumber AS ticket_id, o_custkey AS customer_id,
       CAST(NULL AS BIGINT) AS member_id, CAST(NULL AS STRING) AS category,
       CAST(NULL AS STRING) AS priority, CAST(NULL AS STRING) AS status,
       l_shipdate AS created_at,
       CASE WHEN l_partkey % 11 <> 0
            THEN CAST(CAST(l_shipdate AS DATE) + CAST(l_partkey % 10 - 1 AS INT) AS {naive})
            END AS resolved_at,
       CASE WHEN l_quantity <= 40 THEN CAST(l_quantity AS INT) % 5 + 1 END
         AS satisfaction_score,
       l_linenumber = 1 AS escalated, l_partkey * 100000 + l_suppkey AS row_ord
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
WHERE l_returnflag = 'R'
"""

BILLING_INVOICES = """
SELECT o_custkey AS customer_id,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2))
            * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS amount_usd,
       CASE WHEN o_orderstatus = 'F' THEN 'paid' ELSE 'open' END AS status
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

TEAM_MEMBERS = """
SELECT o_custkey AS customer_id,
       concat(CASE WHEN l_linenumber = 1 THEN 'P' ELSE 'p' END,
              CAST(l_partkey AS STRING), '@m.com') AS email
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
WHERE l_partkey % 10 = 0
"""

ACTIVITY = """
SELECT event_id,
       CASE WHEN event_id % 3 = 0 THEN account END AS customer_id_snake,
       CASE WHEN event_id % 3 = 1 THEN account END AS customer_id_camel,
       CASE WHEN event_id % 3 = 2 AND event_id % 40 <> 2 THEN account END AS customer_id_upper,
       CASE WHEN event_id % 4 = 0 THEN user_id END AS member_id_snake,
       CASE WHEN event_id % 4 = 1 THEN user_id END AS member_id_camel,
       CASE WHEN event_id % 4 = 2 THEN user_id END AS user_id_camel,
       CASE WHEN event_id % 4 = 3 AND event_id % 90 <> 3 THEN user_id END AS user_id_upper,
       CASE WHEN event_id % 3 <> 0 THEN ts END AS ts_native,
       CASE WHEN event_id % 3 <> 0 THEN NULL WHEN event_id % 50 = 0 THEN '01/02/2024'
            ELSE CAST(ts AS STRING) END AS ts_text,
       event_type, CASE WHEN event_id % 4 <> 0 THEN event_type END AS feature,
       CASE WHEN event_id % 7 <> 0 THEN value * 20 END AS session_duration_sec
FROM (SELECT *, CAST(CAST(floor(user_id / 5) AS BIGINT) AS STRING) AS account
      FROM {events}) AS e
"""

ONBOARDING = """
SELECT event_id, user_id AS member_id, ts,
       CASE event_type WHEN 'signup' THEN 'signup' WHEN 'view' THEN 'first_login'
            WHEN 'click' THEN 'workspace_created' WHEN 'purchase' THEN 'first_project'
            ELSE CASE WHEN event_id % 2 = 0 THEN 'invited_teammate' ELSE 'other' END END AS step,
       user_id % 5 >= CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 1
                           WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END AS completed,
       CASE WHEN event_id % 8 <> 0 THEN value END AS duration_seconds
FROM {events}
"""

TABLES = {
    "plans": PLANS,
    "subscriptions": SUBSCRIPTIONS,
    "customers": CUSTOMERS,
    "support_tickets": SUPPORT_TICKETS,
    "billing_invoices": BILLING_INVOICES,
    "team_members": TEAM_MEMBERS,
    "user_activity_logs": ACTIVITY,
    "onboarding_events": ONBOARDING,
}
SOURCES = ("orders", "customer", "nation", "lineitem", "events")

CUSTOMER_ALIASES = ("customer_id_snake", "customer_id_camel", "customer_id_upper")
MEMBER_ALIASES = ("member_id_snake", "member_id_camel", "user_id_camel", "user_id_upper")


class SampleTables:
    """Lazy DataFrames of the logical tables below one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder
        self._tables: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._tables:
            self._tables[table] = self._build(table)
        return self._tables[table]

    def _build(self, table: str) -> DataFrame:
        text = TABLES[table].replace("{naive}", "TIMESTAMP_NTZ")
        used = {
            s: self._spark.read.parquet(f"{self._folder}/{s}.parquet")
            for s in SOURCES
            if "{" + s + "}" in text
        }
        return self._spark.sql(text, **used)


def as_ctes(tables: list[str]) -> str:
    """The same tables as common table expressions for DuckDB (the sources are views there)."""
    parts = []
    for table in tables:
        text = TABLES[table].replace("{naive}", "TIMESTAMP")
        for source in SOURCES:
            text = text.replace("{" + source + "}", source)
        parts.append(f"{table} AS ({text.strip()})")
    return ",\n".join(parts)
