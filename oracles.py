"""DuckDB SQL for the registered queries, composed from shared CTEs."""

from __future__ import annotations

SALT = "spendlight_fixture_salt"


def _ratio(top: str, bottom: str, factor: str = "", digits: int = 2) -> str:
    return (
        f"CASE WHEN ({bottom}) > 0 THEN CAST(ROUND(CAST({factor}CAST({top} AS DOUBLE) / CAST({bottom} AS DOUBLE)"
        f" AS DECIMAL(38,10)), {digits}) AS DOUBLE) END"
    )


def _metrics(spend: str, revenue: str, impressions: str, clicks: str, orders: str, new: str) -> dict[str, str]:
    return {
        "roas": _ratio(revenue, spend),
        "cac": _ratio(spend, new),
        "conv_rate_pct": _ratio(orders, clicks, "100.0 * "),
        "ctr_pct": _ratio(clicks, impressions, "100.0 * "),
    }


_FACT_METRICS = _metrics("spend_usd", "revenue_usd", "impressions", "clicks", "orders", "new_customers")
_TOTAL_METRICS = _metrics(
    "total_spend_usd", "total_revenue_usd", "total_impressions", "total_clicks", "total_orders", "total_new_customers"
)


def _as(metrics: dict[str, str], *names: str) -> str:
    return ", ".join(f"{metrics[n]} AS {n}" for n in (names or metrics))


_MEASURES = ["spend_usd", "revenue_usd", "impressions", "clicks", "orders", "new_customers"]
_MONEY = {"spend_usd", "revenue_usd"}


def _sums(prefix: str = "total_") -> str:
    return ", ".join(
        f"SUM({m}) AS {prefix}{m}" if m in _MONEY else f"CAST(SUM({m}) AS BIGINT) AS {prefix}{m}" for m in _MEASURES
    )


def _dbl(*names: str) -> str:
    return ", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in names)


def _mask(value: str) -> str:
    return f"substring(sha256('{SALT}:' || {value}), 1, 32)"


# Attribute lists of the advertising model.
_TYPES = "['brand_awareness', 'performance', 'prospecting', 'retargeting']"
_STATUSES = "['active', 'paused', 'completed']"
_BUDGETS = "[500, 1000, 2000, 3000, 1500, 2500, 800, 1200]"

_RAW_A = f"""
ev0 AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(ts AS DATE) AS d FROM events
),
ev1 AS (
  SELECT *, ['Meta', 'Google', 'TikTok', 'Other'][k % 4 + 1] AS channel,
         'camp_' || upper(substring(['Meta', 'Google', 'TikTok', 'Other'][k % 4 + 1], 1, 2)) || '_'
           || CASE WHEN k // 4 + 1 < 1000 THEN lpad(CAST(k // 4 + 1 AS VARCHAR), 3, '0')
              ELSE CAST(k // 4 + 1 AS VARCHAR) END AS campaign_id
  FROM ev0
),
span AS (SELECT MIN(d) AS first_day, MAX(d) AS last_day FROM ev0),
ads AS (
  SELECT event_id, user_id, campaign_id, channel, d AS event_date,
         CASE event_type WHEN 'view' THEN 'impression' ELSE 'click' END AS event_type,
         CASE event_type WHEN 'view' THEN CAST(CAST(value AS DECIMAL(18,6)) * 0.01 AS DECIMAL(18,8))
              ELSE CAST(value AS DECIMAL(18,8)) END AS cost_usd
  FROM ev1 WHERE event_type IN ('view', 'click')
),
conv AS (
  SELECT event_id, user_id, campaign_id, channel, d AS conversion_date, event_type AS conversion_type,
         CAST(value AS DECIMAL(18,8)) AS conversion_value_usd,
         CASE event_type WHEN 'signup' THEN 1 ELSE 0 END AS is_new_customer
  FROM ev1 WHERE event_type IN ('purchase', 'signup')
),
campaigns AS (
  SELECT DISTINCT campaign_id, channel || ' Campaign ' || CAST(k // 4 + 1 AS VARCHAR) AS campaign_name, channel,
         {_TYPES}[(k // 4) % 4 + 1] AS campaign_type, {_STATUSES}[(k // 4) % 3 + 1] AS status,
         first_day AS start_date, last_day AS end_date, {_BUDGETS}[(k // 4) % 8 + 1] AS daily_budget_usd
  FROM ev1, span
)"""

_RAW_B = f"""
span AS (SELECT MIN(CAST(l_shipdate AS DATE)) AS first_day, MAX(CAST(l_shipdate AS DATE)) AS last_day FROM lineitem),
ads AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS campaign_id, CAST(l_shipdate AS DATE) AS event_date,
         CASE l_returnflag WHEN 'N' THEN 'impression' ELSE 'click' END AS event_type,
         CASE l_returnflag WHEN 'N' THEN CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * 0.0001 AS DECIMAL(18,8))
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,4)) * 0.01 AS DECIMAL(18,8)) END AS cost_usd
  FROM lineitem WHERE l_returnflag IN ('A', 'N')
),
conv AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS campaign_id, CAST(l_shipdate AS DATE) AS conversion_date,
         CAST(l_extendedprice AS DECIMAL(18,8)) AS conversion_value_usd,
         CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS is_new_customer
  FROM lineitem WHERE l_returnflag = 'R'
),
campaigns AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS campaign_id, s_name AS campaign_name, r_name AS channel,
         {_TYPES}[s_suppkey % 4 + 1] AS campaign_type, {_STATUSES}[s_suppkey % 3 + 1] AS status,
         first_day AS start_date, last_day AS end_date, {_BUDGETS}[s_suppkey % 8 + 1] AS daily_budget_usd
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey, span
)"""

_MODEL = f"""
dim_date AS (
  SELECT CAST(strftime(date_id, '%Y%m%d') AS INTEGER) AS date_key, date_id,
         CAST(year(date_id) AS INTEGER) AS year, CAST(month(date_id) AS INTEGER) AS month,
         CAST(quarter(date_id) AS INTEGER) AS quarter, CAST(day(date_id) AS INTEGER) AS day_of_month,
         CAST(isodow(date_id) - 1 AS INTEGER) AS day_of_week, strftime(date_id, '%A') AS day_name,
         CASE WHEN isodow(date_id) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         strftime(date_id, '%B') AS month_name, CAST(weekofyear(date_id) AS INTEGER) AS week_of_year
  FROM (SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS date_id FROM span)
),
dim_campaign AS (SELECT ROW_NUMBER() OVER (ORDER BY campaign_id) AS campaign_key, * FROM campaigns),
event_agg AS (
  SELECT campaign_id, event_date, SUM(cost_usd) AS spend_usd,
         COUNT(*) FILTER (WHERE event_type = 'impression') AS impressions,
         COUNT(*) FILTER (WHERE event_type = 'click') AS clicks
  FROM ads GROUP BY ALL
),
conv_agg AS (
  SELECT campaign_id, conversion_date, COUNT(*) AS orders, SUM(conversion_value_usd) AS revenue_usd,
         CAST(SUM(is_new_customer) AS BIGINT) AS new_customers
  FROM conv GROUP BY ALL
),
cells AS (
  SELECT dc.campaign_key, CAST(strftime(e.event_date, '%Y%m%d') AS INTEGER) AS date_key, e.event_date AS date,
         dc.channel, dc.campaign_type, e.spend_usd, e.impressions, e.clicks,
         COALESCE(c.orders, 0) AS orders, COALESCE(c.revenue_usd, 0) AS revenue_usd,
         COALESCE(c.new_customers, 0) AS new_customers
  FROM event_agg e
  LEFT JOIN conv_agg c ON e.campaign_id = c.campaign_id AND e.event_date = c.conversion_date
  LEFT JOIN dim_campaign dc ON e.campaign_id = dc.campaign_id
),
fact AS (SELECT *, {_as(_FACT_METRICS)} FROM cells),
channels AS (
  SELECT *, {_as(_TOTAL_METRICS)} FROM (
    SELECT channel, COUNT(DISTINCT campaign_key) AS campaign_count, {_sums()} FROM fact GROUP BY channel)
),
campaign_mart AS (
  SELECT t.*, dc.campaign_name, dc.status, {_as(_TOTAL_METRICS, 'roas', 'cac', 'conv_rate_pct')} FROM (
    SELECT campaign_key, channel, campaign_type, {_sums()} FROM fact GROUP BY ALL) t
  LEFT JOIN dim_campaign dc ON t.campaign_key = dc.campaign_key
),
month_totals AS (
  SELECT d.year, d.month, d.month_name, f.channel, {_sums('')}
  FROM fact f LEFT JOIN dim_date d ON f.date_key = d.date_key GROUP BY ALL
),
monthly AS (
  SELECT year, month, month_name, channel, spend_usd, revenue_usd, orders AS total_orders, new_customers,
         {_as(_FACT_METRICS, 'roas', 'cac')}
  FROM month_totals
),
kpis AS (
  SELECT *,
    CASE WHEN s > 0 THEN r / s ELSE 0.0 END AS roas, CASE WHEN n > 0 THEN s / CAST(n AS DOUBLE) ELSE 0.0 END AS cac,
    CASE WHEN c > 0 THEN CAST(o AS DOUBLE) / CAST(c AS DOUBLE) ELSE 0.0 END * 100 AS conv_rate_pct,
    CASE WHEN i > 0 THEN CAST(c AS DOUBLE) / CAST(i AS DOUBLE) ELSE 0.0 END * 100 AS ctr_pct
  FROM (SELECT CAST(COALESCE(SUM(total_spend_usd), 0) AS DOUBLE) AS s,
               CAST(COALESCE(SUM(total_revenue_usd), 0) AS DOUBLE) AS r,
               CAST(COALESCE(SUM(total_impressions), 0) AS BIGINT) AS i,
               CAST(COALESCE(SUM(total_clicks), 0) AS BIGINT) AS c,
               CAST(COALESCE(SUM(total_orders), 0) AS BIGINT) AS o,
               CAST(COALESCE(SUM(total_new_customers), 0) AS BIGINT) AS n FROM channels)
),
trend AS (
  SELECT date, SUM(spend_usd) AS spend, SUM(revenue_usd) AS revenue,
         {_ratio('SUM(CAST(roas AS DECIMAL(18,2)))', 'COUNT(roas)', digits=6)} AS roas
  FROM fact GROUP BY date
)"""


def _a(select: str) -> str:
    return f"WITH {_RAW_A},{_MODEL}\n{select}"


def _b(select: str) -> str:
    return f"WITH {_RAW_B},{_MODEL}\n{select}"


_RATIOS = ["roas", "cac", "conv_rate_pct", "ctr_pct"]
_FACT_LABELS = "campaign_key, date_key, date, channel, campaign_type"
_FACT_MEASURES = f"{_dbl('spend_usd', 'revenue_usd')}, impressions, clicks, orders, new_customers"
_TOTALS = (
    f"{_dbl('total_spend_usd', 'total_revenue_usd')}, total_impressions, total_clicks, total_orders,"
    " total_new_customers"
)
_FACT = f"SELECT {_FACT_LABELS}, {_FACT_MEASURES}, {', '.join(_RATIOS)} FROM fact"
_CHANNELS = f"SELECT channel, campaign_count, {_TOTALS}, {', '.join(_RATIOS)} FROM channels"
_CAMPAIGNS = (
    f"SELECT campaign_key, campaign_name, channel, campaign_type, status, {_TOTALS}, roas, cac, conv_rate_pct"
    " FROM campaign_mart"
)
_MONTHLY = (
    f"SELECT year, month, month_name, channel, {_dbl('spend_usd', 'revenue_usd')}, total_orders, new_customers,"
    " roas, cac FROM monthly"
)


def _status(roas: str) -> str:
    return (
        f"CASE WHEN {roas} >= 2 THEN 'Excellent' WHEN {roas} >= 1.5 THEN 'Good' WHEN {roas} >= 1 THEN 'Break-even'"
        " ELSE 'Poor' END"
    )


def _color(roas: str) -> str:
    return (
        f"CASE WHEN {roas} >= 2 THEN '#22c55e' WHEN {roas} >= 1.5 THEN '#fbbf24' WHEN {roas} >= 1 THEN '#f97316'"
        " ELSE '#ef4444' END"
    )


def _share(measure: str, name: str) -> str:
    share = _ratio(measure, f"(SELECT SUM({measure}) FROM channels)", "100.0 * ")
    return f"SELECT channel, {_dbl(measure)}, {share} AS {name} FROM channels"


def _ranked(k: int, direction: str) -> str:
    order = f"roas {direction} NULLS LAST, campaign_key"
    return (
        f"SELECT CAST(ROW_NUMBER() OVER (ORDER BY {order}) AS INTEGER) AS rank, campaign_key, campaign_name,"
        f" channel, campaign_type, roas, {_dbl('total_spend_usd', 'total_revenue_usd')} FROM campaign_mart"
        f" ORDER BY {order} LIMIT {k}"
    )


_PRIOR = f"""
SELECT year, month, channel, {_dbl('spend_usd', 'revenue_usd')}, roas,
       prior_roas, CAST(ROUND(CAST(roas - prior_roas AS DECIMAL(38,10)), 2) AS DOUBLE) AS roas_change
FROM (SELECT m.*, p.roas AS prior_roas FROM monthly m LEFT JOIN monthly p
      ON p.channel IS NOT DISTINCT FROM m.channel AND p.year * 12 + p.month = m.year * 12 + m.month - 1)"""


def _plane() -> str:
    """Least squares of revenue on spend, impressions and clicks, by the normal equations of the centred sums."""
    x = {1: "spend_usd", 2: "impressions", 3: "clicks", 4: "revenue_usd"}
    mean = ", ".join(f"AVG(CAST({c} AS DOUBLE)) AS m{i}" for i, c in x.items())
    sums = ", ".join(
        f"SUM((CAST({x[i]} AS DOUBLE) - m{i}) * (CAST({x[j]} AS DOUBLE) - m{j})) AS s{i}{j}"
        for i in range(1, 5) for j in range(i, 5)
    )
    s = lambda i, j: f"s{min(i, j)}{max(i, j)}"

    def det(columns: list[int]) -> str:
        """Determinant of the rows 1 to 3 of these columns."""
        term = lambda i, j, k: f"{s(1, columns[i])} * {s(2, columns[j])} * {s(3, columns[k])}"
        plus, minus = [(0, 1, 2), (1, 2, 0), (2, 0, 1)], [(2, 1, 0), (1, 0, 2), (0, 2, 1)]
        return "(" + " + ".join(term(*p) for p in plus) + " - " + " - ".join(term(*p) for p in minus) + ")"

    slopes = ", ".join(
        f"{det([4 if c == i else c for c in (1, 2, 3)])} / {det([1, 2, 3])} AS b{i}" for i in (1, 2, 3)
    )
    fitted = " + ".join(f"b{i} * (CAST({x[i]} AS DOUBLE) - m{i})" for i in (1, 2, 3))
    return (
        f"SELECT year, month, month_name, channel, {_dbl('spend_usd', 'revenue_usd', 'impressions', 'clicks')}, orders,"
        f" new_customers, ROUND(m4 + {fitted}, 2) AS predicted_revenue_usd FROM month_totals,"
        f" (SELECT m1, m2, m3, m4, {slopes} FROM (SELECT {sums}, m1, m2, m3, m4 FROM month_totals,"
        f" (SELECT {mean} FROM month_totals) GROUP BY ALL))"
    )


def _check(name: str, table: str, checked: str, failed: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, CAST({checked} AS BIGINT) AS n_checked,"
        f" CAST(COALESCE({failed}, 0) AS BIGINT) AS n_failed FROM {table}"
    )


def _all(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _least(table: str, least: int) -> str:
    names = {"ad_events": "ads", "conversions": "conv", "fact_campaign_daily": "fact", "users": "customer"}
    return _check(f"rows:{table}", names.get(table, table), "COUNT(*)", f"GREATEST({least} - COUNT(*), 0)")


def _rule(name: str, table: str, broken: str) -> str:
    return _check(name, table, "COUNT(*)", f"COUNT(*) FILTER (WHERE {broken})")


def _unique(table: str, name: str, *keys: str) -> str:
    groups = f"(SELECT COUNT(*) AS n FROM {table} GROUP BY {', '.join(keys)})"
    return _check(f"unique:{name}({','.join(keys)})", groups, "COALESCE(SUM(n), 0)", "COUNT(*) FILTER (WHERE n > 1)")


def _metric_rule(metric: str) -> str:
    return _rule(f"metric:{metric}", "fact", f"{metric} IS DISTINCT FROM ({_FACT_METRICS[metric]})")


def _dropped() -> str:
    lost = (
        "NOT EXISTS (SELECT 1 FROM event_agg e WHERE e.campaign_id = c.campaign_id"
        " AND e.event_date = c.conversion_date)"
    )
    parts = []
    for name, value in [
        ("cells", "1"), ("orders", "orders"), ("revenue_usd", "revenue_usd"), ("new_customers", "new_customers")
    ]:
        parts.append(
            f"SELECT 'dropped:{name}' AS check_name, CAST(COALESCE(SUM({value}), 0) AS DOUBLE) AS n_checked,"
            f" CAST(COALESCE(SUM({value}) FILTER (WHERE lost), 0) AS DOUBLE) AS n_failed"
            f" FROM (SELECT *, {lost} AS lost FROM conv_agg c)"
        )
    return _all(parts)


def _reconcile() -> str:
    parts = []
    for source, table, prefix in [
        ("channel", "channels", "total_"), ("campaign", "campaign_mart", "total_"),
        ("monthly", "monthly", ""), ("daily", "fact", ""),
    ]:
        for m in _MEASURES:
            if source == "monthly" and m in ("impressions", "clicks"):
                continue  # not in that mart
            column = "total_orders" if source == "monthly" and m == "orders" else prefix + m
            parts.append(
                f"SELECT 'totals:{source}.{m}' AS check_name,"
                f" CAST((SELECT SUM({m}) FROM fact) AS DOUBLE) AS fact_total,"
                f" CAST((SELECT SUM({column}) FROM {table}) AS DOUBLE) AS mart_total,"
                f" CAST(CASE WHEN (SELECT SUM({m}) FROM fact) = (SELECT SUM({column}) FROM {table})"
                " THEN 0 ELSE 1 END AS BIGINT) AS n_failed"
            )
    return _all(parts)


_NOT_NULL = {
    "dim_date": [
        "date_key", "date_id", "year", "month", "quarter", "day_of_month", "day_of_week", "day_name", "is_weekend",
        "month_name",
    ],
    "dim_campaign": [
        "campaign_key", "campaign_id", "campaign_name", "channel", "campaign_type", "status", "start_date",
    ],
    "fact": [
        "campaign_key", "date_key", "date", "channel", "campaign_type", "spend_usd", "impressions", "clicks",
        "orders", "revenue_usd", "new_customers", "roas", "cac", "conv_rate_pct", "ctr_pct",
    ],
}

_DOMAINS = {
    "dim_date": {
        "quarter": "NOT BETWEEN 1 AND 4", "month": "NOT BETWEEN 1 AND 12",
        "day_of_week": "NOT BETWEEN 0 AND 6", "is_weekend": "NOT IN (0, 1)",
    },
    "dim_campaign": {
        "channel": "NOT IN ('Meta', 'Google', 'TikTok', 'Other')",
        "campaign_type": "NOT IN ('brand_awareness', 'performance', 'prospecting', 'retargeting')",
        "status": "NOT IN ('active', 'paused', 'completed')",
    },
}

_USER_IDS = f"(SELECT {_mask('c_name')} AS user_id, c_name AS raw_name FROM customer)"


# Days that end a day or more before the newest one.
_CLOSED = (
    "(SELECT COALESCE(campaign_id, c_id) AS campaign_id, COALESCE(event_date, conversion_date) AS date,"
    " COALESCE(impressions + clicks, 0) AS ad_rows, COALESCE(spend_usd, 0) AS spend_usd,"
    " COALESCE(impressions, 0) AS impressions, COALESCE(clicks, 0) AS clicks, COALESCE(orders, 0) AS orders,"
    " COALESCE(revenue_usd, 0) AS revenue_usd, COALESCE(new_customers, 0) AS new_customers"
    " FROM (SELECT * FROM event_agg e FULL JOIN (SELECT campaign_id AS c_id, * EXCLUDE (campaign_id) FROM conv_agg) c"
    " ON e.campaign_id = c.c_id AND e.event_date = c.conversion_date)"
    " WHERE COALESCE(event_date, conversion_date) <= (SELECT last_day - 2 FROM span))"
)


def oracle_sql() -> dict[str, str]:
    fact_table = {"fact": "fact_campaign_daily"}
    device = "['phone', 'laptop', 'pad'][user_id % 3 + 1]"
    geo = "LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey"
    day = f"SELECT date, channel, {_sums('')} FROM fact GROUP BY ALL"
    queries = {
        "dim_date": _a("SELECT * FROM dim_date"),
        "dim_campaign": _a("SELECT * FROM dim_campaign"),
        "event_agg": _a(f"SELECT campaign_id, event_date, {_dbl('spend_usd')}, impressions, clicks FROM event_agg"),
        "conv_agg": _a(
            f"SELECT campaign_id, conversion_date, orders, {_dbl('revenue_usd')}, new_customers FROM conv_agg"
        ),
        "fact_campaign_daily": _a(_FACT),
        "fact_campaign_daily_b": _b(_FACT),
        "fact_zero_policy": _a(
            f"SELECT {_FACT_LABELS}, {_FACT_MEASURES}, "
            + ", ".join(f"COALESCE({r}, 0.0) AS {r}" for r in _RATIOS)
            + " FROM fact"
        ),
        "mart_channel_summary": _a(_CHANNELS),
        "mart_channel_summary_b": _b(_CHANNELS),
        "mart_campaign_summary": _a(_CAMPAIGNS),
        "mart_campaign_summary_b": _b(_CAMPAIGNS),
        "mart_monthly_summary": _a(_MONTHLY),
        "mart_monthly_summary_b": _b(_MONTHLY),
        "mart_campaign_daily": _a(
            f"SELECT campaign_key, date, channel, campaign_type, {_FACT_MEASURES}, {', '.join(_RATIOS)} FROM fact"
        ),
        "sql_mart_channel": _a(_CHANNELS),
        "sql_mart_campaign": _a(_CAMPAIGNS),
        "sql_mart_monthly": _a(_MONTHLY),
        "overall_kpis": _a(
            "SELECT s AS total_spend_usd, r AS total_revenue_usd, i AS total_impressions, c AS total_clicks,"
            f" o AS total_orders, n AS total_new_customers, {', '.join(_RATIOS)} FROM kpis"
        ),
        "conversion_funnel": _a(
            _all(
                [
                    f"SELECT {step} AS step, '{label}' AS stage, {col} AS value,"
                    f" COALESCE({_ratio(col, 'i', '100.0 * ')}, 0.0) AS pct_of_impressions FROM kpis"
                    for step, (label, col) in enumerate(
                        [("Impressions", "i"), ("Clicks", "c"), ("Orders", "o"), ("New Customers", "n")], 1
                    )
                ]
            )
        ),
        "roas_gauge": _a(
            "SELECT roas, CAST(1.5 AS DOUBLE) AS benchmark, roas - CAST(1.5 AS DOUBLE) AS delta,"
            " CASE WHEN roas >= 2 THEN '2-4' WHEN roas >= 1.5 THEN '1.5-2' WHEN roas >= 1 THEN '1-1.5'"
            " ELSE '0-1' END AS band, GREATEST(CAST(0 AS DOUBLE), LEAST(CAST(4 AS DOUBLE), roas)) AS axis_value,"
            f" {_color('roas')} AS color FROM kpis"
        ),
        "spend_share": _a(_share("total_spend_usd", "spend_share_pct")),
        "revenue_share": _a(_share("total_revenue_usd", "revenue_share_pct")),
        "channel_cards": _a(
            f"SELECT channel, campaign_count, {_dbl('total_spend_usd', 'total_revenue_usd')}, "
            + ", ".join(f"COALESCE({r}, 0.0) AS {r}" for r in _RATIOS)
            + f", {_status('roas')} AS status, CASE WHEN roas >= 1.5 THEN 'good' ELSE 'bad' END AS verdict,"
            " CASE channel WHEN 'Meta' THEN '#1877f2' WHEN 'Google' THEN '#34a853' WHEN 'TikTok' THEN '#ff0050'"
            " ELSE '#64748b' END AS channel_color FROM channels"
        ),
        "channel_roas": _a("SELECT channel, roas FROM channels"),
        "channel_ranked": _a(
            f"SELECT channel, campaign_count, {_dbl('total_spend_usd', 'total_revenue_usd')}, roas FROM channels"
            " ORDER BY roas DESC NULLS LAST, channel"
        ),
        "roas_status": _a(
            f"SELECT campaign_key, roas, {_status('roas')} AS status,"
            " CASE WHEN roas >= 1.5 THEN 'up' WHEN roas >= 1 THEN 'neutral' ELSE 'down' END AS direction,"
            f" {_color('roas')} AS color, CASE WHEN roas >= 1.5 THEN 'good' ELSE 'bad' END AS verdict"
            " FROM campaign_mart"
        ),
        "daily_trend": _a(f"SELECT date, {_dbl('spend', 'revenue')}, roas FROM trend ORDER BY date"),
        "channel_daily_share": _a(
            f"SELECT date, channel, {_dbl('spend_usd')}, {_ratio('spend_usd', 'day_spend', '100.0 * ')} AS share_pct"
            f" FROM (SELECT *, SUM(spend_usd) OVER (PARTITION BY date) AS day_spend FROM ({day}))"
        ),
        "channel_daily_trend": _a(
            f"SELECT date, channel, {_FACT_MEASURES}, {_as(_FACT_METRICS)} FROM ({day}) ORDER BY date, channel"
        ),
        "campaign_options": _a(
            "SELECT campaign_name || ' (' || channel || ')' AS label, campaign_key FROM campaign_mart"
        ),
        "campaign_lookup": _a(
            f"SELECT campaign_key, campaign_name, {_dbl('total_spend_usd', 'total_revenue_usd')}, roas, cac"
            " FROM campaign_mart WHERE campaign_key = 1"
        ),
        "campaign_daily_series": _a(
            f"SELECT campaign_key, date, {_dbl('spend_usd', 'revenue_usd')}, roas FROM fact WHERE campaign_key = 1"
            " ORDER BY date"
        ),
        "top5_roas": _a(_ranked(5, "DESC")),
        "bottom5_roas": _a(_ranked(5, "ASC")),
        "top10_roas": _a(_ranked(10, "DESC")),
        "roas_filtered": _a(
            f"SELECT {_dbl('spend_usd', 'revenue_usd')}, {_as(_FACT_METRICS, 'roas')} FROM ("
            " SELECT SUM(f.spend_usd) AS spend_usd, SUM(f.revenue_usd) AS revenue_usd FROM fact f"
            " JOIN dim_campaign c ON f.campaign_key = c.campaign_key WHERE c.channel = 'Meta'"
            " AND c.campaign_type = 'prospecting' AND f.date_key BETWEEN 20240101 AND 20240131)"
        ),
        "roas_alerts": _a(
            f"SELECT campaign_key, campaign_name, channel, roas, {_dbl('total_spend_usd', 'total_revenue_usd')}"
            " FROM campaign_mart WHERE roas < 1.0"
        ),
        "weekly_summary": _a(
            f"SELECT week_start, channel, {_FACT_MEASURES}, {_as(_FACT_METRICS)} FROM ("
            f" SELECT CAST(date_trunc('week', date) AS DATE) AS week_start, channel, {_sums('')}"
            " FROM fact GROUP BY ALL)"
        ),
        "roas_vs_prior_month": _a(_PRIOR),
        "roas_vs_prior_month_b": _b(_PRIOR),
        "roas_by_geo": _a(
            f"SELECT geo, {_FACT_MEASURES}, {_as(_FACT_METRICS)} FROM (SELECT geo, {_sums('')} FROM"
            " (SELECT n_name AS geo, cost_usd AS spend_usd, 0 AS revenue_usd,"
            " CASE event_type WHEN 'impression' THEN 1 ELSE 0 END AS impressions,"
            " CASE event_type WHEN 'click' THEN 1 ELSE 0 END AS clicks,"
            f" 0 AS orders, 0 AS new_customers FROM ads {geo}"
            " UNION ALL SELECT n_name, 0, conversion_value_usd, 0, 0, 1, is_new_customer"
            f" FROM conv {geo}) GROUP BY geo)"
        ),
        "traffic_by_device": _a(
            f"SELECT device, {_dbl('spend_usd')}, impressions, clicks, {_as(_FACT_METRICS, 'ctr_pct')} FROM ("
            f" SELECT {device} AS device, SUM(cost_usd) AS spend_usd,"
            " COUNT(*) FILTER (WHERE event_type = 'impression') AS impressions,"
            " COUNT(*) FILTER (WHERE event_type = 'click') AS clicks FROM ads GROUP BY ALL)"
        ),
        "revenue_regression": _a(
            "SELECT ROUND(regr_slope(CAST(revenue AS DOUBLE), CAST(spend AS DOUBLE)), 6) AS slope,"
            " ROUND(regr_intercept(CAST(revenue AS DOUBLE), CAST(spend AS DOUBLE)), 4) AS intercept,"
            " COUNT(*) AS n FROM trend"
        ),
        "traffic_by_event_geo": _a(
            f"SELECT geo, {_dbl('spend_usd')}, impressions, clicks, {_as(_FACT_METRICS, 'ctr_pct')} FROM ("
            " SELECT 'g' || CAST(user_id % 5 AS VARCHAR) AS geo, SUM(cost_usd) AS spend_usd,"
            " COUNT(*) FILTER (WHERE event_type = 'impression') AS impressions,"
            " COUNT(*) FILTER (WHERE event_type = 'click') AS clicks FROM ads GROUP BY ALL)"
        ),
        "masked_user_join": _a(
            f"SELECT country_code, CAST(COUNT(*) AS BIGINT) AS events, COUNT(DISTINCT {_mask('a.user_id')}) AS users,"
            " CAST(COUNT(*) FILTER (WHERE u.user_id IS NULL) AS BIGINT) AS orphans FROM ads a LEFT JOIN"
            f" (SELECT {_mask('c_custkey')} AS user_id, n_name AS country_code FROM customer"
            " LEFT JOIN nation ON c_nationkey = n_nationkey) u"
            f" ON u.user_id = {_mask('a.user_id')} GROUP BY country_code"
        ),
        "dq_orders_are_conversions": _a(
            _check(
                "orders:conversions", "conv", "COUNT(*)",
                "ABS(COUNT(*) - (SELECT SUM(orders) FROM fact) - (SELECT COALESCE(SUM(orders), 0) FROM conv_agg c"
                " WHERE NOT EXISTS (SELECT 1 FROM event_agg e WHERE e.campaign_id = c.campaign_id"
                " AND e.event_date = c.conversion_date)))",
            )
        ),
        "dq_event_types": _rule(
            "domain:events.event_type", "events", "event_type NOT IN ('view', 'click', 'purchase', 'signup')"
        ),
        "dq_money_on_grid": (
            "SELECT 'grid:ad_events.cost_usd' AS check_name, COUNT(*) AS n_checked, COUNT(*) FILTER (WHERE"
            " ROUND(cost * 1e8) / 1e8 <> cost) AS n_failed FROM (SELECT ROUND(l_extendedprice * 100)"
            " / CASE l_returnflag WHEN 'N' THEN 1000000 ELSE 10000 END AS cost FROM lineitem"
            " WHERE l_returnflag IN ('A', 'N')) UNION ALL"
            " SELECT 'grid:conversions.conversion_value_usd', COUNT(*), COUNT(*) FILTER (WHERE"
            " ROUND(l_extendedprice * 1e8) / 1e8 <> l_extendedprice) FROM lineitem WHERE l_returnflag = 'R'"
        ),
        "revenue_regression_ml": _b(_plane()),
        "calendar_scalars": _a(
            "SELECT strftime(date_id, '%Y-%m-%d') AS date_text, date_id AS parsed, year, month, day_of_month,"
            " quarter, week_of_year, day_of_week FROM dim_date"
        ),
        "pii_masked_users": (
            f"SELECT {_mask('c_name')} AS user_id, ['to 24', '25-39', '40-59', '60 on'][c_custkey % 4 + 1] AS age_band,"
            " ['f', 'm', 'x'][c_custkey % 3 + 1] AS gender, n_name AS country_code,"
            " lower(c_mktsegment) AS acquisition_channel, c_acctbal AS lifetime_value_usd"
            " FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"
        ),
        "short_hash_ids": _a(
            f"SELECT 'ev_' || substring({_mask('event_id')}, 1, 12) AS id, 'ad_event' AS kind FROM ads UNION ALL"
            f" SELECT 'cv_' || substring({_mask('event_id')}, 1, 12) AS id, 'conversion' AS kind FROM conv"
        ),
        "dq_row_counts": _a(
            _all(
                [
                    _least("campaigns", 32), _least("users", 100), _least("ad_events", 3000),
                    _least("conversions", 195), _least("dim_date", 28), _least("dim_campaign", 32),
                    _least("fact_campaign_daily", 992),
                ]
            )
        ),
        "dq_pii_masked": _all(
            [
                _rule(f"masked:{c}", _USER_IDS, f"NOT COALESCE(regexp_full_match({c}, '[0-9a-f]{{32}}'), false)")
                for c in ("user_id", "raw_name")
            ]
        ),
        "dq_metric_reconcile": _a(_all([_metric_rule(m) for m in _RATIOS])),
        "dq_pk_duplicates": _a(
            _all(
                [
                    _unique("dim_date", "dim_date", "date_key"),
                    _unique("dim_campaign", "dim_campaign", "campaign_key"),
                    _unique("fact", "fact_campaign_daily", "campaign_key", "date_key"),
                ]
            )
        ),
        "dq_pk_duplicates_b": _unique("lineitem", "lineitem", "l_orderkey", "l_linenumber"),
        "dq_not_null": _a(
            _all(
                [
                    _rule(f"not_null:{fact_table.get(t, t)}.{c}", t, f"{c} IS NULL")
                    for t, columns in _NOT_NULL.items()
                    for c in columns
                ]
            )
        ),
        "dq_fk_orphans": _a(
            _all(
                [
                    _rule(
                        f"orphans:fact_campaign_daily.{c}", "fact f",
                        f"NOT EXISTS (SELECT 1 FROM {p} p WHERE p.{c} = f.{c})",
                    )
                    for c, p in (("campaign_key", "dim_campaign"), ("date_key", "dim_date"))
                ]
            )
        ),
        "dq_dropped_conversions": _a(_dropped()),
        "dq_domains": _a(
            _all(
                [
                    _rule(f"domain:{t}.{c}", t, f"{c} {broken}")
                    for t, rules in _DOMAINS.items()
                    for c, broken in rules.items()
                ]
            )
        ),
        "dq_totals_reconcile": _a(_reconcile()),
        "scan_csv_roundtrip": _a(
            f"SELECT 'cv_' || substring({_mask('event_id')}, 1, 12) AS conversion_id, conversion_date, campaign_id,"
            " channel, CAST(user_id AS VARCHAR) AS user_id, conversion_type,"
            f" {_dbl('conversion_value_usd')}, is_new_customer FROM conv"
        ),
        "scan_fact": _a(_FACT),
        "partition_pruned_scan": _a(f"{_FACT} WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-16'"),
        "catalog_registered_fact": _a(_FACT),
        "dim_campaign_stable": _a(
            "SELECT * REPLACE (ROW_NUMBER() OVER (ORDER BY status = 'paused', campaign_id) AS campaign_key)"
            " FROM dim_campaign"
        ),
        "incremental_fact": _a(_FACT),
        "incremental_mart_channel": _a(_CHANNELS),
        "incremental_mart_campaign": _a(_CAMPAIGNS),
        "incremental_mart_monthly": _a(_MONTHLY),
        "distinct_campaigns_by_period": _a(" UNION ALL ".join(
            f"SELECT '{period}' AS period, CAST({start} AS DATE) AS first_day, channel,"
            " COUNT(DISTINCT campaign_key) AS campaigns FROM fact GROUP BY ALL"
            for period, start in (
                ("day", "date"), ("week", "date_trunc('week', date)"), ("month", "date_trunc('month', date)"),
                ("all", "NULL"),
            )
        )),
        "stream_closed_days": _a(
            f"SELECT campaign_id, date, ad_rows, {_dbl('spend_usd')}, impressions, clicks, orders,"
            f" {_dbl('revenue_usd')}, new_customers FROM {_CLOSED}"
        ),
        "stream_roas_alerts": _a(
            f"SELECT campaign_id, date, {_dbl('spend_usd')}, {_dbl('revenue_usd')} FROM ("
            " SELECT *, COALESCE(LAG(below) OVER (PARTITION BY campaign_id ORDER BY date), FALSE) AS was FROM ("
            "  SELECT *, spend_usd > 0 AND revenue_usd < spend_usd AS below FROM ("
            "   SELECT campaign_id, date, SUM(spend_usd) OVER w AS spend_usd, SUM(revenue_usd) OVER w AS revenue_usd"
            f"   FROM {_CLOSED} WINDOW w AS (PARTITION BY campaign_id ORDER BY date))))"
            " WHERE below AND NOT was"
        ),
        "stream_daily_metrics": _a(
            f"SELECT campaign_id, date, {_FACT_MEASURES}, {_as(_FACT_METRICS)} FROM ("
            " SELECT e.campaign_id, e.event_date AS date, e.spend_usd, e.impressions, e.clicks,"
            " COALESCE(c.orders, 0) AS orders, COALESCE(c.revenue_usd, 0) AS revenue_usd,"
            " COALESCE(c.new_customers, 0) AS new_customers FROM event_agg e LEFT JOIN conv_agg c"
            " ON e.campaign_id = c.campaign_id AND e.event_date = c.conversion_date)"
        ),
    }
    return queries
