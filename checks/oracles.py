"""Independent SQL for every query, run by DuckDB on the same sample tables.

The texts state the result in the plainest way (all pairs, whole-group windows, correlated
sums); they share no structure with the Spark plans.
"""

from __future__ import annotations

from keepsight.sources.sample_tables import as_ctes

AS_OF = "TIMESTAMP '2001-08-01'"


def _sql(tables: list[str], body: str) -> str:
    return f"WITH {as_ctes(tables)}{',' if tables else ''}\n{body.strip()}"


# ---------------------------------------------------------------- shared pieces

EVENTS = r"""
ev AS (
  SELECT event_id,
         TRY_CAST(coalesce(customer_id_snake, customer_id_camel, customer_id_upper) AS BIGINT)
           AS cid,
         coalesce(member_id_snake, member_id_camel, user_id_camel, user_id_upper) AS mid,
         CASE WHEN ts_native IS NOT NULL THEN ts_native
              WHEN regexp_matches(ts_text, '^\d{4}-\d{2}-\d{2}')
              THEN TRY_CAST(ts_text AS TIMESTAMP) END AS tick,
         feature AS raw_feature, coalesce(feature, event_type) AS any_feature, event_type,
         session_duration_sec AS secs
  FROM user_activity_logs)
"""

FREE = """
free_accounts AS (
  SELECT DISTINCT customer_id FROM subscriptions
  WHERE status = 'active'
    AND plan_id IN (SELECT plan_id FROM plans WHERE plan_tier = 'free'))
"""

SCORE = """
round_even(0.4 * days / greatest(1.0, epoch_us(seen_to - seen_from) / 86400e6)
           + 0.3 * least(feats / 10.0, 1.0)
           + 0.3 * least(coalesce({secs}, 0) / 3600.0, 1.0), 4)
"""


def _members(feature: str, where: str) -> str:
    return f"""
      SELECT cid, mid, count(*) AS n, count(DISTINCT CAST(tick AS DATE)) AS days,
             count(DISTINCT {feature}) AS feats, avg(secs) AS secs,
             min(tick) AS seen_from, max(tick) AS seen_to
      FROM ev WHERE tick IS NOT NULL AND mid IS NOT NULL AND {where}
      GROUP BY cid, mid"""


ROLLUP = f"""
{EVENTS},
rolled AS (SELECT * REPLACE (round_even(secs, 0) AS secs)
           FROM ({_members('any_feature', 'cid IS NOT NULL')})),
capped AS (SELECT * REPLACE (least(secs, 86400) AS secs),
                  greatest(1.0, epoch_us(seen_to - seen_from) / 86400e6) AS tenure
           FROM rolled),
scored AS (SELECT *, {SCORE.format(secs='secs')} AS score FROM capped),
account_use AS (
  SELECT cid, sum(n) AS n, max(days) AS days, max(feats) AS feats, avg(secs) AS secs,
         max(score) AS score, count(mid) AS members
  FROM scored GROUP BY cid)
"""

CLEAN = r"""
tidy_customers AS (
  SELECT * EXCLUDE (mail, signup_date, churned_at, contact_email, nps_score),
         CASE WHEN regexp_matches(signup_date, '^\d{4}-\d{2}-\d{2}')
              THEN TRY_CAST(signup_date AS TIMESTAMP) END AS signup_date,
         churned_at,
         CASE WHEN regexp_matches(mail, '^[^@]+@[^@]+\.[^@]+$') THEN mail END AS contact_email,
         CASE WHEN nps_score >= 0 AND nps_score <= 10 THEN nps_score END AS nps_score,
         coalesce(NOT is_active, false) AS is_churned
  FROM (SELECT *, lower(regexp_replace(contact_email, '^\s+|\s+$', '', 'g')) AS mail
        FROM customers)),
tidy_subs AS (
  SELECT s.* EXCLUDE (end_date, mrr_usd), CASE WHEN end_date < start_date THEN NULL
         ELSE end_date END AS end_date, CASE WHEN mrr_usd < 0 THEN NULL ELSE mrr_usd END AS mrr_usd,
         plan_name, plan_tier, monthly_price_usd
  FROM subscriptions s, plans p WHERE p.plan_id = s.plan_id),
newest AS (
  SELECT * FROM tidy_subs QUALIFY row_number() OVER (PARTITION BY customer_id
    ORDER BY start_date DESC NULLS LAST, subscription_id DESC) = 1),
tidy_tickets AS (
  SELECT * EXCLUDE (hours), CASE WHEN hours >= 0 THEN hours END AS resolution_hours
  FROM (SELECT *, epoch_us(resolved_at - created_at) / 3600e6 AS hours FROM support_tickets
        QUALIFY row_number() OVER (PARTITION BY ticket_id ORDER BY row_ord) = 1)),
loads AS (
  SELECT customer_id, count(ticket_id) AS tickets, avg(satisfaction_score) AS satisfaction,
         count(*) FILTER (WHERE escalated) AS escalations
  FROM tidy_tickets WHERE created_at >= TIMESTAMP '2001-02-01' GROUP BY customer_id)
"""

MASTER = f"""
{ROLLUP},
{CLEAN},
joined AS (
  SELECT c.*, s.plan_tier, s.plan_name, s.mrr_usd, s.status, s.start_date, s.end_date,
         s.billing_cycle, s.cancellation_reason, coalesce(l.tickets, 0) AS ticket_count,
         l.satisfaction AS avg_satisfaction, coalesce(l.escalations, 0) AS escalated_count,
         coalesce(a.n, 0) AS total_events, coalesce(a.days, 0) AS days_active,
         coalesce(a.feats, 0) AS feature_count, coalesce(a.secs, 0) AS avg_session_sec,
         coalesce(a.score, 0) AS engagement_score, a.members AS member_count
  FROM tidy_customers c LEFT JOIN newest s USING (customer_id)
  LEFT JOIN loads l USING (customer_id) LEFT JOIN account_use a ON a.cid = c.customer_id),
master AS (
  SELECT *, ticket_count > 3 AS high_ticket,
         CASE WHEN ticket_count = 0 THEN '0 tickets' WHEN ticket_count = 1 THEN '1 ticket'
              WHEN ticket_count <= 3 THEN '2-3 tickets' WHEN ticket_count <= 6
              THEN '4-6 tickets' WHEN ticket_count <= 100 THEN '7+ tickets' END
           AS ticket_bucket,
         CASE WHEN is_churned THEN
                CASE WHEN ticket_count > 3 THEN 'Churned — High Friction'
                     ELSE 'Churned — Low Engagement' END
              WHEN plan_tier IS NOT DISTINCT FROM 'free' THEN
                CASE WHEN engagement_score >= 0.5 THEN 'Upsell Candidates'
                     ELSE 'Inactive Free Tier' END
              WHEN coalesce(mrr_usd, 0) >= 100 THEN 'Champions'
              WHEN ticket_count > 3 THEN 'At-Risk Paid' ELSE 'Stable Paid' END
           AS segment_label
  FROM joined)
"""

MASTER_TABLES = ["plans", "subscriptions", "customers", "support_tickets", "user_activity_logs"]

CUSTOMER_OUT = """customer_id, company_name, industry, company_size, country_code, country_name,
  timezone, contact_email, CAST(signup_date AS VARCHAR) AS signup_date, is_active,
  CAST(churned_at AS VARCHAR) AS churned_at, churn_reason,
  CAST(nps_score AS BIGINT) AS nps_score, is_churned"""

SUBSCRIPTION_OUT = """subscription_id, customer_id, CAST(plan_id AS BIGINT) AS plan_id, status,
  billing_cycle, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date,
  round(mrr_usd, 6) AS mrr_usd, discount_pct, CAST(trial_end_date AS VARCHAR) AS trial_end_date,
  cancellation_reason, plan_name, plan_tier, CAST(monthly_price_usd AS DOUBLE)
    AS monthly_price_usd"""

MEMBER_OUT = """cid AS customer_id, mid AS member_id, n AS total_events, days AS days_active,
  feats AS feature_count, secs AS avg_session_sec, CAST(seen_from AS VARCHAR) AS first_seen,
  CAST(seen_to AS VARCHAR) AS last_seen"""

MASTER_OUT = f"""{CUSTOMER_OUT}, plan_tier, plan_name, round(mrr_usd, 6) AS mrr_usd, status,
  CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date, billing_cycle,
  cancellation_reason, ticket_count, round(avg_satisfaction, 6) AS avg_satisfaction,
  escalated_count, CAST(total_events AS BIGINT) AS total_events, days_active, feature_count,
  round(avg_session_sec, 6) AS avg_session_sec, engagement_score, member_count, high_ticket,
  ticket_bucket, segment_label"""

DASHBOARD = """
fills AS (SELECT round_even(quantile_cont(nps_score, 0.5), 1) AS nps FROM master),
export AS (
  SELECT customer_id, coalesce(company_name, 'Unknown') AS company_name,
    coalesce(industry, 'Unknown') AS industry, coalesce(company_size, 'Unknown') AS company_size,
    coalesce(country_code, 'Unknown') AS country_code,
    coalesce(country_name, 'Unknown') AS country_name, coalesce(timezone, 'Unknown') AS timezone,
    coalesce(contact_email, 'Unknown') AS contact_email,
    CAST(signup_date AS VARCHAR) AS signup_date, CAST(is_active AS BIGINT) AS is_active,
    coalesce(CAST(churned_at AS VARCHAR), '0') AS churned_at,
    coalesce(churn_reason, 'Not Churned') AS churn_reason,
    CAST(coalesce(nps_score, (SELECT nps FROM fills)) AS DOUBLE) AS nps_score,
    CAST(is_churned AS BIGINT) AS is_churned, coalesce(plan_tier, 'Unknown') AS plan_tier,
    coalesce(plan_name, 'Unknown') AS plan_name, round(coalesce(mrr_usd, 0), 6) AS mrr_usd,
    coalesce(status, 'Unknown') AS status,
    coalesce(CAST(start_date AS VARCHAR), '') AS start_date,
    coalesce(CAST(end_date AS VARCHAR), '0') AS end_date,
    coalesce(billing_cycle, 'Unknown') AS billing_cycle,
    coalesce(cancellation_reason, 'Not Cancelled') AS cancellation_reason, ticket_count,
    round(coalesce(avg_satisfaction, 0), 6) AS avg_satisfaction, escalated_count,
    CAST(total_events AS BIGINT) AS total_events, days_active, feature_count,
    round(avg_session_sec, 6) AS avg_session_sec, engagement_score, member_count,
    CAST(high_ticket AS BIGINT) AS high_ticket, ticket_bucket, segment_label,
    CASE ticket_bucket WHEN '0 tickets' THEN 1 WHEN '1 ticket' THEN 2 WHEN '2-3 tickets' THEN 3
      WHEN '4-6 tickets' THEN 4 WHEN '7+ tickets' THEN 5 ELSE 99 END::BIGINT
      AS ticket_bucket_sort
  FROM master)
"""

# Column order of the master dataset and of the export, for the profiles.
MASTER_COLUMNS = (
    "customer_id company_name industry company_size country_code country_name timezone "
    "contact_email signup_date is_active churned_at churn_reason nps_score is_churned plan_tier "
    "plan_name mrr_usd status start_date end_date billing_cycle cancellation_reason ticket_count "
    "avg_satisfaction escalated_count total_events days_active feature_count avg_session_sec "
    "engagement_score member_count high_ticket ticket_bucket segment_label"
).split()
NUMERIC_COLUMNS = (
    "customer_id nps_score is_churned is_active mrr_usd ticket_count avg_satisfaction "
    "escalated_count total_events days_active feature_count avg_session_sec engagement_score "
    "member_count high_ticket ticket_bucket_sort"
).split()


def _master(body: str, extra: str = "") -> str:
    return _sql(MASTER_TABLES, MASTER + extra + body)


def _nulls(position: int, column: str) -> str:
    before = "CAST(NULL AS BIGINT)"
    if column in MASTER_COLUMNS:
        before = f"(SELECT count(*) FROM master WHERE {column} IS NULL)"
    return (
        f"SELECT {position}::BIGINT AS position, '{column}' AS column_name, "
        f"{before} AS nulls_before, "
        f"(SELECT count(*) FROM export WHERE {column} IS NULL) AS nulls_after"
    )


def _profile(position: int, column: str) -> str:
    if column in NUMERIC_COLUMNS:
        return (
            f"SELECT {position}::BIGINT AS position, '{column}' AS column_name, "
            f"'numeric' AS kind, round_even(min({column})::DOUBLE, 2) AS min_value, "
            f"round_even(max({column})::DOUBLE, 2) AS max_value, "
            "CAST(NULL AS BIGINT) AS unique_values FROM export"
        )
    return (
        f"SELECT {position}::BIGINT, '{column}', 'other', CAST(NULL AS DOUBLE), "
        f"CAST(NULL AS DOUBLE), count(DISTINCT {column}) FROM export"
    )


NULL_ROWS = "\nUNION ALL ".join(
    _nulls(i, c) for i, c in enumerate([*MASTER_COLUMNS, "ticket_bucket_sort"], start=1)
)
PROFILE_ROWS = "\nUNION ALL ".join(
    _profile(i, c) for i, c in enumerate([*MASTER_COLUMNS, "ticket_bucket_sort"], start=1)
)

GRAMS = r"""
named AS (
  SELECT customer_id, company_name, contact_email,
         lower(split_part(contact_email, '@', 2)) AS dom,
         list_distinct(flatten(list_transform(
           list_filter(string_split(regexp_replace(lower(trim(company_name)),
                                    '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda w: length(w) > 0),
           lambda w: list_transform(range(1, length(w) + 2),
                                    lambda i: substr('  ' || w || ' ', i, 3))))) AS g
  FROM customers WHERE contact_email <> ''),
alike AS (
  SELECT * FROM (
    SELECT x.customer_id AS p, y.customer_id AS q,
           len(list_intersect(x.g, y.g)) / (len(x.g) + len(y.g) - len(list_intersect(x.g, y.g)))
             AS sim
    FROM named x, named y WHERE x.customer_id < y.customer_id)
  WHERE sim > 0.7)
"""

ORACLES: dict[str, str] = {}

# ---------------------------------------------------------------- plans and subscriptions

ORACLES["plan_health"] = _sql(["plans", "subscriptions", "support_tickets"], f"""
load AS (
  SELECT customer_id, count(*) AS t FROM support_tickets
  WHERE created_at >= TIMESTAMP '2001-02-01' AND created_at <= {AS_OF} GROUP BY ALL)
SELECT plan_name, plan_tier, count(DISTINCT s.customer_id) AS active_customers,
       round(avg(CASE billing_cycle WHEN 'monthly' THEN monthly_price_usd::DOUBLE
                 WHEN 'annual' THEN annual_price_usd / 12 ELSE 0 END), 2)
         AS avg_monthly_revenue_usd,
       round(sum(coalesce(t, 0)) / count(DISTINCT s.customer_id) / 6, 3)
         AS tickets_per_customer_per_month
FROM subscriptions s JOIN plans USING (plan_id) LEFT JOIN load USING (customer_id)
WHERE status = 'active' GROUP BY plan_id, plan_name, plan_tier
""")

ORACLES["ltv_by_tier"] = _sql(
    ["plans", "subscriptions", "customers", "billing_invoices"], """
spent AS (SELECT customer_id, sum(amount_usd) AS v FROM billing_invoices
          WHERE status = 'paid' GROUP BY ALL),
last_sub AS (SELECT * FROM subscriptions
             QUALIFY subscription_id = max(subscription_id) OVER (PARTITION BY customer_id)),
valued AS (
  SELECT plan_tier, c.customer_id, company_name, coalesce(v, 0) AS v
  FROM customers c JOIN last_sub USING (customer_id) JOIN plans USING (plan_id)
  LEFT JOIN spent USING (customer_id) WHERE last_sub.status <> 'trial')
SELECT plan_tier, rank() OVER (PARTITION BY plan_tier ORDER BY v DESC) AS tier_rank, customer_id,
       company_name, CAST(round(v, 2) AS DOUBLE) AS ltv_usd,
       round(avg(v) OVER tier, 2) AS tier_avg_ltv_usd,
       round((v::DOUBLE - avg(v) OVER tier) / nullif(avg(v) OVER tier, 0) * 100, 1)
         AS pct_diff_from_tier_avg
FROM valued WINDOW tier AS (PARTITION BY plan_tier)
""")

ORACLES["downgrades_after_tickets"] = _sql(
    ["plans", "subscriptions", "customers", "support_tickets"], """
lv AS (SELECT *, list_position(['free', 'starter', 'professional', 'enterprise'], plan_tier)
         AS lvl FROM plans),
steps AS (SELECT customer_id, start_date AS d, plan_id AS new_plan, lag(plan_id) OVER (
            PARTITION BY customer_id ORDER BY start_date, subscription_id) AS old_plan
          FROM subscriptions),
drops AS (
  SELECT customer_id, d, o.plan_name AS old_name, n.plan_name AS new_name,
         o.monthly_price_usd AS old_price, n.monthly_price_usd AS new_price
  FROM steps JOIN lv n ON n.plan_id = new_plan JOIN lv o ON o.plan_id = old_plan
  WHERE (n.lvl, n.monthly_price_usd) < (o.lvl, o.monthly_price_usd)
    AND d >= DATE '2001-01-01' AND d <= DATE '2001-08-01'),
hits AS (
  SELECT x.customer_id, x.d, count(*) AS k
  FROM drops x JOIN support_tickets t ON t.customer_id = x.customer_id
   AND t.created_at >= x.d - 90 AND t.created_at <= x.d::TIMESTAMP GROUP BY ALL)
SELECT drops.customer_id, company_name, industry, CAST(drops.d AS VARCHAR) AS downgrade_date,
       k AS tickets_before_downgrade, old_name AS previous_plan, new_name AS current_plan,
       old_price::DOUBLE AS prev_price, new_price::DOUBLE AS curr_price,
       (old_price - new_price)::DOUBLE AS monthly_revenue_lost
FROM hits JOIN drops ON drops.customer_id = hits.customer_id AND drops.d = hits.d
JOIN customers c ON c.customer_id = drops.customer_id
""")

ORACLES["churn_trend"] = _sql(["plans", "subscriptions"], """
s AS (SELECT plan_tier, status, date_trunc('month', start_date)::DATE AS m0,
             date_trunc('month', end_date)::DATE AS m1 FROM subscriptions JOIN plans USING (plan_id)),
gained AS (SELECT plan_tier, m0 AS m, count(*) AS a,
                  count(*) FILTER (WHERE status IN ('active', 'cancelled')) AS b
           FROM s GROUP BY ALL),
gone AS (SELECT plan_tier, m1 AS m, count(*) AS c FROM s
         WHERE status = 'cancelled' AND m1 IS NOT NULL GROUP BY ALL),
months AS (
  SELECT plan_tier, m, coalesce(a, 0) AS a, coalesce(c, 0) AS c,
         CASE WHEN coalesce(b, 0) = 0 THEN 1 ELSE b END AS b
  FROM gained FULL JOIN gone USING (plan_tier, m) WHERE m IS NOT NULL),
rates AS (
  SELECT *, lag(a) OVER (PARTITION BY plan_tier ORDER BY m) AS a0, 100.0 * c / b AS r,
         avg(100.0 * c / b) OVER (PARTITION BY plan_tier ORDER BY m ROWS 2 PRECEDING) AS r3
  FROM months)
SELECT plan_tier, CAST(m AS VARCHAR) AS month, a AS new_subs,
       round(100.0 * (a - a0) / nullif(a0, 0), 2) AS mom_growth_pct, c AS churned_subs,
       round(r, 3) AS churn_rate_pct, round(r3, 3) AS rolling_3m_avg_churn_pct,
       CASE WHEN round(r, 3) > 2 * round(r3, 3) THEN '⚠ CHURN SPIKE' END AS churn_alert
FROM rates
""")

ORACLES["duplicate_accounts"] = _sql(["customers", "team_members"], GRAMS + """,
dom_pairs AS (SELECT x.customer_id AS p, y.customer_id AS q FROM named x JOIN named y
              ON x.dom = y.dom AND x.customer_id < y.customer_id),
mem_pairs AS (SELECT x.customer_id AS p, y.customer_id AS q, count(*) AS k
              FROM team_members x JOIN team_members y ON lower(x.email) = lower(y.email)
               AND x.customer_id < y.customer_id GROUP BY ALL),
pairs AS (
  SELECT p, q, sum(d) AS d, sum(s) AS s, sum(m) AS m, max(sim) AS sim, max(k) AS k FROM (
    SELECT p, q, 1 AS d, 0 AS s, 0 AS m, 0.0::DOUBLE AS sim, 0 AS k FROM dom_pairs UNION ALL
    SELECT p, q, 0, 1, 0, sim, 0 FROM alike UNION ALL
    SELECT p, q, 0, 0, 1, 0.0, k FROM mem_pairs) GROUP BY p, q)
SELECT p AS cust_a, x.company_name AS company_a, x.contact_email AS email_a,
       q AS cust_b, y.company_name AS company_b, y.contact_email AS email_b,
       CAST(d + s + m AS BIGINT) AS signals_fired, round(sim, 6) AS name_similarity,
       CAST(k AS BIGINT) AS shared_members, if(d = 1, 'YES', 'NO') AS same_email_domain,
       'HIGH' AS duplicate_confidence
FROM pairs JOIN customers x ON x.customer_id = p JOIN customers y ON y.customer_id = q
WHERE d + s + m >= 2
""")

ORACLES["name_similarity_join"] = _sql(["customers"], GRAMS + """
SELECT p AS cust_a, q AS cust_b, round(sim, 6) AS name_similarity FROM alike
""")

ORACLES["name_similarity_names"] = _sql(["customers"], GRAMS + """,
labels AS (SELECT customer_id, lower(trim(company_name)) AS name FROM named),
totals AS (SELECT name, min(customer_id) AS first, count(*) AS accounts FROM labels GROUP BY name),
found AS (
  SELECT least(x.name, y.name) AS name_a, greatest(x.name, y.name) AS name_b, count(*) AS account_pairs,
         round(max(sim), 6) AS similarity
  FROM alike JOIN labels x ON x.customer_id = p JOIN labels y ON y.customer_id = q GROUP BY 1, 2)
SELECT name_a, name_b, x.first AS first_a, y.first AS first_b, x.accounts AS accounts_a,
       y.accounts AS accounts_b, account_pairs, similarity
FROM found JOIN totals x ON x.name = name_a JOIN totals y ON y.name = name_b
""")

ORACLES["name_similarity_members"] = _sql(["customers"], """
mailed AS (SELECT * FROM customers WHERE length(contact_email) > 0)
SELECT customer_id, lower(trim(company_name)) AS name FROM mailed WHERE company_name IS NOT NULL
""")

ORACLES["tier_customers"] = _sql(
    ["plans", "subscriptions"], f"{FREE} SELECT customer_id FROM free_accounts"
)

ORACLES["tier_id_arrays"] = _sql(["plans", "subscriptions"], f"""{FREE}
SELECT customer_id // 100 AS chunk, string_agg(customer_id::VARCHAR, ',' ORDER BY customer_id)
  AS customer_ids FROM free_accounts GROUP BY ALL
""")

ORACLES["tier_id_texts"] = _sql(["plans", "subscriptions"], f"""{FREE}
SELECT (place - 1) // 100 AS chunk, string_agg(id, ', ' ORDER BY id) AS customer_ids
FROM (SELECT customer_id::VARCHAR AS id, row_number() OVER (ORDER BY customer_id::VARCHAR) AS place
      FROM free_accounts)
GROUP BY ALL
""")

# ---------------------------------------------------------------- events

LOG = ["user_activity_logs"]
LOG_AND_FREE = ["plans", "subscriptions", "user_activity_logs"]

ORACLES["normalize_events"] = _sql(LOG, f"""{EVENTS}
SELECT event_id, event_type, any_feature AS feature, round(secs, 6) AS session_duration_sec,
       cid AS customer_id, mid AS member_id, CAST(tick AS VARCHAR) AS ts FROM ev
""")

ORACLES["document_events"] = _sql(LOG, f"""{EVENTS}
SELECT cid AS customer_id, mid AS member_id, CAST(tick AS VARCHAR) AS ts, event_type,
       raw_feature AS feature, round(secs, 6) AS session_duration_sec FROM ev
""")

ORACLES["scanned_events"] = _sql(LOG, f"""{EVENTS}
SELECT cid AS customer_id, mid AS member_id, CAST(tick AS VARCHAR) AS ts, event_type,
       raw_feature AS feature, round(secs, 6) AS session_duration_sec FROM ev
WHERE event_id % 97 <> 0 AND event_id % 89 <> 0
""")

ORACLES["scan_report"] = _sql(LOG, """
kinds AS (SELECT event_id % 97 = 0 OR event_id % 89 = 0 AS bad FROM user_activity_logs)
SELECT 'documents' AS step, count(*) FILTER (WHERE NOT bad) AS lines FROM kinds
UNION ALL SELECT 'rejected lines', count(*) FILTER (WHERE bad) FROM kinds
""")

ORACLES["first_featured_document"] = _sql(LOG, """
featured AS (SELECT event_id, event_type, feature FROM user_activity_logs WHERE feature IS NOT NULL)
SELECT * FROM featured WHERE event_id = (SELECT min(event_id) FROM featured)
""")

ORACLES["document_presence"] = _sql(LOG, """
names AS (SELECT concat_ws(',', if(customer_id_snake IS NULL, NULL, 'customer_id'),
                           if(customer_id_camel IS NULL, NULL, 'customerId'),
                           if(customer_id_upper IS NULL, NULL, 'customerID')) AS present_fields
          FROM user_activity_logs)
SELECT present_fields, count(*) AS documents FROM names GROUP BY ALL
""")

ORACLES["event_cleaning_report"] = _sql(LOG, f"""{EVENTS}
SELECT 'events' AS step, count(*) AS rows FROM ev
UNION ALL SELECT 'customer_id missing or invalid', count(*) FROM ev WHERE cid IS NULL
UNION ALL SELECT 'member_id missing or invalid', count(*) FROM ev WHERE mid IS NULL
UNION ALL SELECT 'ts missing or invalid', count(*) FROM ev WHERE tick IS NULL
UNION ALL SELECT 'complete', count(*) FROM ev
  WHERE cid IS NOT NULL AND mid IS NOT NULL AND tick IS NOT NULL
""")

WEEKLY = f"""{EVENTS},
weeks AS (SELECT cid, mid, isoyear(tick) AS y, week(tick) AS w, count(*) AS c,
                 avg(secs) AS s
          FROM ev WHERE tick IS NOT NULL AND cid IS NOT NULL AND mid IS NOT NULL GROUP BY ALL),
placed AS (SELECT *, count(*) OVER (PARTITION BY cid, mid) AS n, row_number() OVER (
             PARTITION BY cid, mid ORDER BY s NULLS FIRST) - 1 AS i FROM weeks),
people AS (SELECT cid, mid, avg(c) AS c, max(s) FILTER (WHERE i = floor(n * 0.25)) AS s25,
                  max(s) FILTER (WHERE i = floor(n * 0.5)) AS s50,
                  max(s) FILTER (WHERE i = floor(n * 0.75)) AS s75 FROM placed GROUP BY ALL),
busiest AS (
  SELECT cid AS customer_id, round(avg(c), 6) AS avg_sessions_per_user_per_week,
         round(avg(s25), 6) AS p25_session_dur_sec, round(avg(s50), 6) AS p50_session_dur_sec,
         round(avg(s75), 6) AS p75_session_dur_sec, count(*) AS user_count
  FROM people GROUP BY cid ORDER BY round(avg(c), 9) DESC, cid LIMIT 100)
"""

ORACLES["weekly_sessions"] = _sql(LOG, f"""{WEEKLY}
SELECT * FROM busiest
""")

ORACLES["weekly_sessions_by_tier"] = _sql(["plans", "subscriptions", *LOG], f"""{WEEKLY},
tiers AS (
  SELECT customer_id, plan_tier FROM subscriptions JOIN plans USING (plan_id)
  QUALIFY row_number() OVER (PARTITION BY customer_id
    ORDER BY start_date DESC NULLS LAST, subscription_id DESC) = 1)
SELECT busiest.*, plan_tier FROM busiest LEFT JOIN tiers USING (customer_id)
""")

ORACLES["feature_retention"] = _sql(LOG, f"""{EVENTS},
used AS (SELECT DISTINCT mid, raw_feature AS f, tick::DATE AS d FROM ev
         WHERE tick IS NOT NULL AND mid IS NOT NULL AND raw_feature IS NOT NULL),
begun AS (SELECT mid, f, min(d) AS d0, count(*) AS k FROM used GROUP BY ALL),
flagged AS (SELECT *, EXISTS (SELECT 1 FROM used u WHERE u.mid = b.mid AND u.f = b.f
              AND u.d > b.d0 AND u.d <= b.d0 + 7) AS back FROM begun b)
SELECT f AS feature, count(*) AS total_unique_users, count(*) FILTER (WHERE back)
         AS retained_users, CAST(sum(k) AS BIGINT) AS total_person_days,
       round_even(count(*) FILTER (WHERE back) * 100.0 / count(*), 2) AS retention_rate_7d_pct,
       round_even(sum(k) / 30.0, 1) AS avg_dau_estimate
FROM flagged GROUP BY f
""")

STAGES = """
firsts AS (
  SELECT mid, pos, step, dur FROM (
    SELECT member_id AS mid, step, duration_seconds AS dur, ts, event_id,
           list_position(['signup', 'first_login', 'workspace_created', 'first_project',
                          'invited_teammate'], step) AS pos
    FROM onboarding_events WHERE completed AND member_id IS NOT NULL)
  WHERE pos IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY mid, pos ORDER BY ts, event_id) = 1),
stages AS (
  SELECT pos, pos || '_' || step AS funnel_step, count(*) AS users,
         list_sort(list(dur) FILTER (WHERE dur IS NOT NULL)) AS ds
  FROM firsts GROUP BY pos, step)
"""

ORACLES["funnel_stages"] = _sql(["onboarding_events"], f"""{STAGES}
SELECT funnel_step, users AS unique_users,
       round(ds[len(ds) // 2 + 1], 6) AS median_step_duration_sec FROM stages
""")

ORACLES["funnel_dropoff"] = _sql(["onboarding_events"], f"""{STAGES}
SELECT x.funnel_step AS from_step, y.funnel_step AS to_step,
       round((x.users - y.users) * 100.0 / x.users, 1) AS dropoff_pct
FROM stages x JOIN stages y ON y.pos = x.pos + 1
""")


ORACLES["document_funnel"] = ORACLES["funnel_stages"]
ORACLES["document_funnel_dropoff"] = ORACLES["funnel_dropoff"]


def _upsell(feature: str, gate: str) -> str:
    where = "cid IN (SELECT customer_id FROM free_accounts)"
    return _sql(LOG_AND_FREE, f"""{FREE}, {EVENTS},
people AS ({_members(feature, where)})
SELECT cid AS customer_id, mid AS member_id, {SCORE.format(secs='secs')} AS engagement_score,
       days AS days_active, feats AS feature_count, round_even(secs, 0) AS avg_session_dur_sec,
       n AS total_events, CAST(seen_to AS VARCHAR) AS last_seen
FROM people WHERE {gate} ORDER BY engagement_score DESC, cid, mid LIMIT 20
""")


ORACLES["upsell_targets"] = _upsell("raw_feature", "true")
ORACLES["upsell_targets_gated"] = _upsell("any_feature", "(days > 1 OR n > 2 OR feats > 1)")

ORACLES["activity_by_member"] = _sql(LOG, f"{ROLLUP} SELECT {MEMBER_OUT} FROM rolled")

ORACLES["member_engagement"] = _sql(
    LOG,
    f"{ROLLUP} SELECT {MEMBER_OUT}, round(tenure, 6) AS tenure_days, score AS engagement_score "
    "FROM scored",
)

ORACLES["customer_engagement"] = _sql(LOG, f"""{ROLLUP}
SELECT cid AS customer_id, CAST(n AS BIGINT) AS total_events, days AS days_active,
       feats AS feature_count, round(secs, 6) AS avg_session_sec, score AS engagement_score,
       members AS member_count FROM account_use
""")

ORACLES["field_presence"] = _sql(LOG, """
flags AS (SELECT if(customer_id_snake IS NULL, 'missing', 'present') AS customer_id_snake,
                 if(customer_id_camel IS NULL, 'missing', 'present') AS customer_id_camel,
                 if(customer_id_upper IS NULL, 'missing', 'present') AS customer_id_upper
          FROM user_activity_logs)
SELECT *, count(*) AS documents FROM flags GROUP BY ALL
""")

ORACLES["feature_presence"] = _sql(LOG, """
flags AS (SELECT if(feature IS NULL, 'missing', 'present') AS feature FROM user_activity_logs)
SELECT feature, count(*) AS documents FROM flags GROUP BY ALL
""")

ORACLES["event_types"] = _sql(LOG, """
kinds AS (SELECT DISTINCT event_type FROM user_activity_logs)
SELECT event_type FROM kinds WHERE event_type IS NOT NULL
""")

ORACLES["member_count"] = _sql(LOG, """
ids AS (SELECT member_id_snake AS v FROM user_activity_logs)
SELECT count(DISTINCT v) AS distinct_values FROM ids
""")

ORACLES["first_customer_ids"] = _sql(LOG, f"""{EVENTS}
SELECT DISTINCT cid AS customer_id FROM ev WHERE cid IS NOT NULL ORDER BY cid LIMIT 20
""")

ORACLES["id_coverage"] = _sql(LOG_AND_FREE, f"""{FREE}, {EVENTS}
SELECT count(*) AS customers_with_events FROM free_accounts
WHERE customer_id IN (SELECT cid FROM ev)
""")

ORACLES["heavy_users"] = _sql(LOG, """
sizes AS (SELECT customer_id_snake, member_id_snake, count(*) AS events
          FROM user_activity_logs GROUP BY ALL)
SELECT * FROM sizes WHERE events > 1
ORDER BY events DESC, customer_id_snake NULLS LAST, member_id_snake NULLS LAST LIMIT 5
""")

ORACLES["events_of"] = _sql(LOG, """
hits AS (SELECT * FROM user_activity_logs
         WHERE customer_id_snake = '7' OR customer_id_camel = '7')
SELECT event_id, customer_id_snake, customer_id_camel, event_type FROM hits
""")

ORACLES["sample_rows"] = _sql(LOG, """
first_rows AS (SELECT * FROM user_activity_logs ORDER BY event_id LIMIT 5)
SELECT customer_id_snake, customer_id_camel FROM first_rows
""")

ORACLES["event_count"] = "SELECT count(*) AS documents FROM events"

# ---------------------------------------------------------------- cleaning and master

CLEAN_TABLES = ["plans", "subscriptions", "customers", "support_tickets"]

ORACLES["clean_customers"] = _sql(
    CLEAN_TABLES, f"{CLEAN} SELECT {CUSTOMER_OUT} FROM tidy_customers"
)
ORACLES["clean_subscriptions"] = _sql(
    CLEAN_TABLES, f"{CLEAN} SELECT {SUBSCRIPTION_OUT} FROM tidy_subs"
)
ORACLES["latest_subscription"] = _sql(
    CLEAN_TABLES, f"{CLEAN} SELECT {SUBSCRIPTION_OUT} FROM newest"
)
ORACLES["clean_tickets"] = _sql(CLEAN_TABLES, f"""{CLEAN}
SELECT ticket_id, customer_id, member_id, category, priority, status,
       CAST(created_at AS VARCHAR) AS created_at, CAST(resolved_at AS VARCHAR) AS resolved_at,
       CAST(satisfaction_score AS BIGINT) AS satisfaction_score, escalated, row_ord,
       round(resolution_hours, 6) AS resolution_hours FROM tidy_tickets
""")
ORACLES["ticket_summary"] = _sql(CLEAN_TABLES, f"""{CLEAN}
SELECT customer_id, tickets AS ticket_count, round(satisfaction, 6) AS avg_satisfaction,
       escalations AS escalated_count FROM loads
""")

ORACLES["cleaning_report"] = _sql(MASTER_TABLES, MASTER + """,
facts AS (
  SELECT 'customers' AS table_name, 1 AS step_number, 'drop duplicates' AS step,
         (SELECT count(*) FROM customers) AS rows_before,
         (SELECT count(DISTINCT customer_id) FROM customers) AS rows_after, 0 AS values_changed
  UNION ALL SELECT 'customers', 2, 'signup_date missing', NULL, NULL,
         (SELECT count(*) FROM tidy_customers WHERE signup_date IS NULL)
  UNION ALL SELECT 'customers', 3, 'churned_at missing', NULL, NULL,
         (SELECT count(*) FROM tidy_customers WHERE churned_at IS NULL)
  UNION ALL SELECT 'customers', 4, 'contact_email invalid', NULL, NULL,
         (SELECT count(*) FROM tidy_customers WHERE contact_email IS NULL)
  UNION ALL SELECT 'customers', 5, 'nps_score out of range', NULL, NULL,
         (SELECT count(*) FROM customers WHERE nps_score < 0 OR nps_score > 10)
  UNION ALL SELECT 'subscriptions', 1, 'drop duplicates', (SELECT count(*) FROM subscriptions),
         (SELECT count(DISTINCT subscription_id) FROM subscriptions), 0
  UNION ALL SELECT 'subscriptions', 2, 'end_date before start_date', NULL, NULL,
         (SELECT count(*) FROM subscriptions WHERE end_date < start_date)
  UNION ALL SELECT 'subscriptions', 3, 'mrr_usd negative', NULL, NULL,
         (SELECT count(*) FROM subscriptions WHERE mrr_usd < 0)
  UNION ALL SELECT 'tickets', 1, 'drop duplicates', (SELECT count(*) FROM support_tickets),
         (SELECT count(DISTINCT ticket_id) FROM support_tickets), 0
  UNION ALL SELECT 'tickets', 2, 'resolution negative', NULL, NULL,
         (SELECT count(*) FROM tidy_tickets WHERE resolved_at < created_at)
  UNION ALL SELECT 'activity', 1, 'drop duplicates', (SELECT count(*) FROM rolled),
         (SELECT count(*) FROM rolled), 0
  UNION ALL SELECT 'activity', 2, 'avg_session_sec capped', NULL, NULL,
         (SELECT count(*) FROM rolled WHERE secs > 86400)),
filled AS (
  SELECT table_name, step_number, step, values_changed,
         first_value(rows_after) OVER w AS rows_after,
         CASE WHEN step_number = 1 THEN rows_before ELSE first_value(rows_after) OVER w END
           AS rows_before
  FROM facts WINDOW w AS (PARTITION BY table_name ORDER BY step_number))
SELECT table_name, CAST(step_number AS BIGINT) AS step_number, step, rows_before, rows_after,
       rows_before - rows_after AS rows_dropped, CAST(values_changed AS BIGINT) AS values_changed
FROM filled
""")

ORACLES["merge_report"] = _master("""
SELECT 1::BIGINT AS step_number, 'latest subscriptions' AS merged_part,
       (SELECT count(*) FROM newest) AS part_rows, (SELECT count(*) FROM tidy_customers) AS rows_before,
       count(*) AS rows_after, count(n.customer_id) AS rows_matched
FROM tidy_customers c LEFT JOIN newest n USING (customer_id)
UNION ALL
SELECT 2, 'ticket summary', (SELECT count(*) FROM loads), (SELECT count(*) FROM tidy_customers),
       count(*), count(l.customer_id)
FROM tidy_customers c LEFT JOIN newest n USING (customer_id) LEFT JOIN loads l USING (customer_id)
UNION ALL
SELECT 3, 'engagement', (SELECT count(*) FROM account_use), (SELECT count(*) FROM tidy_customers),
       (SELECT count(*) FROM master), count(a.cid)
FROM tidy_customers c LEFT JOIN account_use a ON a.cid = c.customer_id
""")
ORACLES["master_dataset"] = _master(f"SELECT {MASTER_OUT} FROM master")
ORACLES["assign_segments"] = _master(
    "SELECT customer_id, high_ticket, ticket_bucket, segment_label FROM master"
)
ORACLES["dashboard_clean"] = _master("SELECT * FROM export", "," + DASHBOARD)
ORACLES["dashboard_csv"] = _master(
    "SELECT *, CAST(NULL AS VARCHAR) AS rejected_row FROM export", "," + DASHBOARD
)
ORACLES["null_profile"] = _master(NULL_ROWS, "," + DASHBOARD)
ORACLES["null_verdict"] = _master("""
SELECT (SELECT count(*) FROM master) AS row_count, count(nulls_before) AS columns_before,
       count(*) AS columns_after, CAST(sum(nulls_before) AS BIGINT) AS nulls_before,
       CAST(sum(nulls_after) AS BIGINT) AS nulls_after, sum(nulls_after) = 0 AS zero_nulls
FROM holes
""", f",{DASHBOARD}, holes AS ({NULL_ROWS}) ")
ORACLES["column_profile"] = _master(PROFILE_ROWS, "," + DASHBOARD)

# ---------------------------------------------------------------- reports on the master

ORACLES["churn_by_ticket_group"] = _master("""
SELECT high_ticket, count(*) AS customers, round(avg(is_churned::INT), 6) AS churn_rate
FROM master GROUP BY high_ticket
""")

ORACLES["mann_whitney"] = _master("""
SELECT a AS n_high, b AS n_low, u AS u_statistic, round(z, 6) AS z,
       round(CASE WHEN z >= 0 THEN tail ELSE 1 - tail END, 6) AS p_value,
       CASE WHEN z >= 0 THEN tail ELSE 1 - tail END < 0.05 AS reject_h0
FROM (
  SELECT *, exp(-z * z / 2) / 2 * (0.254829592 * k - 0.284496736 * k ** 2 + 1.421413741 * k ** 3
         - 1.453152027 * k ** 4 + 1.061405429 * k ** 5) AS tail
  FROM (SELECT *, 1 / (1 + 0.3275911 * abs(z) / sqrt(2)) AS k FROM score))
""", """,
v AS (SELECT high_ticket AS h, is_churned::INT AS x FROM master),
wins AS (SELECT sum(CASE WHEN p.x > q.x THEN 1.0 WHEN p.x = q.x THEN 0.5 ELSE 0 END)::DOUBLE AS u
         FROM v p, v q WHERE p.h AND NOT q.h),
sizes AS (SELECT count(*) FILTER (WHERE h) AS a, count(*) FILTER (WHERE NOT h) AS b,
                 count(*)::DOUBLE AS t, count(*) FILTER (WHERE x = 0)::DOUBLE AS c0,
                 count(*) FILTER (WHERE x = 1)::DOUBLE AS c1 FROM v),
score AS (SELECT a, b, u, (u - a * b / 2 - 0.5) / sqrt(a * b / 12 * (t + 1
            - (c0 ** 3 - c0 + c1 ** 3 - c1) / (t * (t - 1)))) AS z FROM wins, sizes)
""")

ORACLES["normality_screen"] = _master("""
SELECT high_ticket, n, round(m3 / m2 ** 1.5, 6) AS skewness,
       round(m4 / m2 ** 2 - 3, 6) AS excess_kurtosis, round(jb, 6) AS jarque_bera,
       round(exp(-jb / 2), 6) AS p_value,
       CASE WHEN exp(-jb / 2) > 0.05 THEN 'NORMAL' WHEN jb IS NOT NULL THEN 'NOT normal'
            ELSE 'insufficient data' END AS verdict
FROM (SELECT *, n / 6.0 * ((m3 / m2 ** 1.5) ** 2 + (m4 / m2 ** 2 - 3) ** 2 / 4) AS jb
      FROM moments)
""", """,
v AS (SELECT high_ticket, is_churned::DOUBLE AS x,
             avg(is_churned::DOUBLE) OVER (PARTITION BY high_ticket) AS mu FROM master),
moments AS (SELECT high_ticket, count(*) AS n, avg((x - mu) ** 2) AS m2, avg((x - mu) ** 3) AS m3,
                   avg((x - mu) ** 4) AS m4 FROM v GROUP BY high_ticket)
""")

ORACLES["ticket_buckets"] = _master("""
SELECT ticket_bucket, count(*) AS customers, round_even(avg(is_churned::INT), 3) AS churn_rate
FROM master WHERE ticket_bucket IS NOT NULL GROUP BY ticket_bucket
""")

ORACLES["segment_profile"] = _master("""
SELECT segment_label, count(*) AS n_customers, round_even(avg(is_churned::INT), 3) AS churn_rate,
       round_even(avg(engagement_score), 3) AS avg_engagement,
       round_even(avg(mrr_usd), 3) AS avg_mrr, round_even(avg(ticket_count), 3) AS avg_tickets,
       round_even(avg(days_active), 3) AS avg_days_active,
       round_even(avg(CASE WHEN plan_tier = 'free' THEN 1 ELSE 0 END), 3) AS pct_free_tier
FROM master GROUP BY segment_label
""")

for _key, _column in (("churn_by_tier", "plan_tier"), ("churn_by_industry", "industry")):
    ORACLES[_key] = _master(f"""
SELECT {_column}, count(*) AS customers, round(avg(is_churned::INT), 6) AS churn_rate
FROM master WHERE {_column} IS NOT NULL GROUP BY {_column}
""")

ORACLES["engagement_vs_revenue"] = _master("""
SELECT plan_tier, count(*) AS customers, round(avg(engagement_score), 6) AS avg_engagement,
       round(avg(coalesce(mrr_usd, 0)), 6) AS avg_mrr FROM master GROUP BY plan_tier
""")

ORACLES["score_distribution"] = _master("""
SELECT is_churned, count(*) AS n, round(quantile_cont(engagement_score, 0.25), 6) AS q1,
       round(quantile_cont(engagement_score, 0.5), 6) AS median,
       round(quantile_cont(engagement_score, 0.75), 6) AS q3
FROM master GROUP BY is_churned
""")

ORACLES["score_histogram"] = _master("""
SELECT is_churned, bin, round((bin - 1)::DOUBLE * 0.1, 6) AS bin_start, count(*) AS n
FROM (SELECT is_churned, CASE WHEN engagement_score = 1.5 THEN 15 WHEN engagement_score > 1.5
               THEN 16 ELSE CAST(floor(engagement_score * 15 / 1.5) AS BIGINT) + 1 END AS bin
      FROM master)
GROUP BY ALL
""")

ORACLES["segment_sizes"] = _master(
    "SELECT segment_label, count(*) AS n_customers FROM master GROUP BY segment_label"
)
ORACLES["segment_mrr"] = _master("""
SELECT segment_label, coalesce(round_even(avg(mrr_usd), 3), 0) AS avg_mrr
FROM master GROUP BY segment_label
""")

ORACLES["mrr_box_stats"] = _master("""
SELECT plan_tier, n, round(q[1], 6) AS q1, round(q[2], 6) AS median, round(q[3], 6) AS q3,
       round((SELECT least(min(mrr_usd), q[1]) FROM master m
              WHERE m.plan_tier = boxes.plan_tier
                AND mrr_usd >= q[1] - 1.5 * (q[3] - q[1])), 6) AS whisker_low,
       round((SELECT greatest(max(mrr_usd), q[3]) FROM master m
              WHERE m.plan_tier = boxes.plan_tier
                AND mrr_usd <= q[3] + 1.5 * (q[3] - q[1])), 6) AS whisker_high
FROM boxes
""", """,
boxes AS (SELECT plan_tier, count(mrr_usd) AS n, quantile_cont(mrr_usd, [0.25, 0.5, 0.75]) AS q
          FROM master WHERE plan_tier IS NOT NULL GROUP BY plan_tier)
""")

ORACLES["kpis"] = _master("""
SELECT count(*) AS customers, round(avg(is_churned::INT), 6) AS churn_rate,
       round(avg(coalesce(mrr_usd, 0)), 6) AS avg_revenue,
       count(DISTINCT segment_label) AS segments FROM master
""")

ORACLES["engagement_coverage"] = _master("""
SELECT count(*) AS customers, count(*) FILTER (WHERE engagement_score > 0) AS with_engagement,
       count(*) FILTER (WHERE engagement_score = 0) AS without_engagement FROM master
""")
