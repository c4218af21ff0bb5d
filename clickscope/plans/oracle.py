"""DuckDB SQL building blocks for the oracle side of every query.

Each query's oracle is a hand-written SQL string over the pre-registered test
views; the derived fixtures of FIXTURES.md are common table expressions here.
"""

from __future__ import annotations

from clickscope.plans.fixtures import SESSION_FEATURES, SCORE_CUT


def _rule(j: int) -> str:
    return f"(user_id * 31 + day(session_date) * 7) % 50 <> {j}"


_SESS_DAY = """sess_day AS (
  SELECT user_id, CAST(ts AS DATE) AS session_date,
         SUM(value) AS time_on_site, AVG(value) AS avg_session_time,
         COUNT(*) FILTER (WHERE event_type = 'view') AS n_view,
         COUNT(*) FILTER (WHERE event_type = 'signup') AS n_signup,
         COUNT(*) FILTER (WHERE event_type = 'purchase') AS n_purchase,
         COUNT(*) FILTER (WHERE event_type = 'error') AS n_error,
         COUNT(*) FILTER (WHERE event_type = 'click') AS n_click,
         COUNT(*) AS n_events,
         arg_min(props, event_id) AS first_props
  FROM events GROUP BY user_id, CAST(ts AS DATE))"""

_SESS_FULL = """sess_full AS (
  SELECT d.user_id * 100000000 + CAST(strftime(d.session_date, '%Y%m%d') AS BIGINT) AS session_id, d.user_id, d.session_date,
         CAST(13 + d.user_id % 88 AS DOUBLE) AS age,
         c.c_mktsegment AS gender,
         CASE CAST(json_extract_string(d.first_props, '$.k') AS BIGINT) % 3
              WHEN 0 THEN 'Desktop' WHEN 1 THEN 'Mobile' ELSE 'Tablet' END AS device_type,
         CAST(d.time_on_site AS DOUBLE) AS time_on_site,
         CAST(d.n_view AS DOUBLE) AS pages_viewed,
         CAST(COALESCE(SUM(d.n_purchase) OVER (PARTITION BY d.user_id ORDER BY d.session_date
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS previous_purchases,
         CAST(d.n_signup AS DOUBLE) AS cart_items,
         CAST(d.n_error > 0 AS DOUBLE) AS discount_seen,
         CAST(d.session_date > MIN(d.session_date) OVER (PARTITION BY d.user_id) AS DOUBLE) AS returning_user,
         CAST(d.avg_session_time AS DOUBLE) AS avg_session_time,
         CAST(d.n_events = 1 AS DOUBLE) AS bounce_rate,
         CAST(d.n_purchase > 0 AS DOUBLE) AS purchase,
         CAST(d.n_click > 0 AS DOUBLE) AS ad_clicked
  FROM sess_day d LEFT JOIN customer c ON d.user_id = c.c_custkey)"""

_SESSIONS = ("sessions AS (\n  SELECT session_id, user_id, session_date,\n"
             + ",\n".join(f"         CASE WHEN {_rule(j)} THEN {c} END AS {c}"
                          for j, c in enumerate(SESSION_FEATURES))
             + "\n  FROM sess_full)")

SESSIONS_CTES = [_SESS_DAY, _SESS_FULL, _SESSIONS]

RAW_CTE = ("raw AS (SELECT session_id, " + ", ".join(SESSION_FEATURES) + " FROM sessions)")

# median over ALL rows (before the target filter), then fill, then filter
CLEAN_CTES = SESSIONS_CTES + [
    RAW_CTE,
    "med AS (SELECT median(avg_session_time) AS m FROM raw)",
    """filled AS (
  SELECT r.session_id, r.age, COALESCE(r.gender, 'Unknown') AS gender,
         COALESCE(r.device_type, 'Unknown') AS device_type, r.time_on_site, r.pages_viewed,
         r.previous_purchases, r.cart_items, r.discount_seen, r.returning_user,
         COALESCE(r.avg_session_time, med.m) AS avg_session_time, r.bounce_rate, r.purchase,
         r.ad_clicked
  FROM raw r, med WHERE r.ad_clicked IS NOT NULL)""",
    """labels AS (
  SELECT feature, label, CAST(dense_rank() OVER (PARTITION BY feature ORDER BY label) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT 'gender' AS feature, gender AS label FROM filled
        UNION SELECT DISTINCT 'device_type', device_type FROM filled
        UNION SELECT 'gender', 'Unknown' UNION SELECT 'device_type', 'Unknown'))""",
    """processed AS (
  SELECT f.session_id, f.age, g.code AS gender, d.code AS device_type, f.time_on_site,
         f.pages_viewed, f.previous_purchases, f.cart_items, f.discount_seen, f.returning_user,
         f.avg_session_time, f.bounce_rate, f.purchase, f.ad_clicked
  FROM filled f
  JOIN labels g ON g.feature = 'gender' AND g.label = f.gender
  JOIN labels d ON d.feature = 'device_type' AND d.label = f.device_type)""",
]

SCORED_CTES = [f"""scored AS (
  SELECT l.doc_id, CAST(l.quality AS INTEGER) AS label,
         CAST(d.n_chars AS DOUBLE) / (SELECT MAX(d2.n_chars) FROM labels l2 JOIN documents d2 ON l2.doc_id = d2.doc_id) AS score,
         d.lang AS subgroup
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)""",
               f"""scored_p AS (
  SELECT doc_id, label, score, CAST(score >= {SCORE_CUT} AS INTEGER) AS prediction, subgroup FROM scored)"""]


def with_ctes(ctes: list[str], body: str) -> str:
    """Join CTE blocks (deduplicated, order kept) in front of a SELECT."""
    seen, out = set(), []
    for c in ctes:
        if c not in seen:
            seen.add(c)
            out.append(c)
    return "WITH " + ",\n".join(out) + "\n" + body
