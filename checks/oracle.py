"""The same queries as plain SQL, independent of the Spark plans.

All texts share one WITH prefix: fixture -> staging -> marts -> parameters.
Numbers are compared as doubles rounded to six places; statistics that are
defined with fewer places are rounded by exact integer arithmetic here.
"""

from __future__ import annotations

from checks.fixture import CALC_DATE, CFG, FACT_FROM, HISTORY_DATES, PREVIOUS_DATE, STOPPED_FROM, STRICT

# Standard normal quantiles.
Z_VALUES = {0.90: 1.2815515655446004, 0.95: 1.6448536269514722, 0.98: 2.0537489106318225}

FMT = "'%Y-%m-%d %H:%M:%S'"

STAGING = f"""
fx AS (
  SELECT o_orderkey AS k, o_orderstatus AS status, o_orderdate AS d,
         CAST(CASE WHEN o_orderkey % 101 = 0 THEN 0 ELSE 3 + (o_orderkey * 37) % 23 END AS INTEGER) AS h,
         CAST(14 + (o_orderkey * 11) % 15 AS INTEGER) AS p
  FROM orders),
raw_orders AS (
  SELECT CAST(k AS VARCHAR) AS order_id, status, strftime(d, {FMT}) AS ordered_at,
         CASE WHEN k % 97 = 0 THEN NULL WHEN k % 499 = 0 THEN 'not-a-date'
              WHEN k % 503 = 0 THEN '2001' WHEN k % 509 = 0 THEN '2001-3' WHEN k % 521 = 0 THEN ' 2001-01-02 '
              ELSE strftime(d + to_days(h), {FMT}) END AS received_at,
         strftime(d + to_days(p), {FMT}) AS promised_at,
         CASE WHEN k % 5 = 0 THEN NULL WHEN k % 89 = 0 THEN strftime(d + to_days(h + 3), {FMT})
              ELSE strftime(d + to_days(h // 2), {FMT}) END AS dispatched_at
  FROM fx),
raw_lines AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS line_no,
         CAST(l_partkey AS VARCHAR) AS product_id,
         'S' || CAST(b - CASE WHEN b >= 7 AND p_type = 'PROMO'
                               AND o_orderdate >= TIMESTAMP '{STOPPED_FROM}' THEN 5 ELSE 0 END AS VARCHAR)
           AS supplier_id,
         CAST(CAST(((2 * cents + qty) // (2 * qty)) / 100.0 AS DECIMAL(18,2)) AS VARCHAR) AS unit_value,
         CASE WHEN l_linenumber = 7 THEN NULL
              ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity
  FROM (SELECT *, CAST(floor(sqrt(l_suppkey)) AS BIGINT) AS b, CAST(l_quantity AS BIGINT) AS qty,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem) l
  JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
raw_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
         CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_type END AS category
  FROM (SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_partkey % 61 = 0)),
raw_labels AS (
  SELECT DISTINCT p_type AS category,
         CASE WHEN p_type = 'LARGE' THEN '' ELSE lower(p_type) || '_goods' END AS label
  FROM part WHERE p_type <> 'ECONOMY'),
raw_suppliers AS (
  SELECT 'S' || CAST(b AS VARCHAR) AS supplier_id, n_name AS city, r_name AS region
  FROM (SELECT CAST(floor(sqrt(s_suppkey)) AS BIGINT) AS b, arg_min(s_nationkey, s_suppkey) AS nk
        FROM supplier GROUP BY 1) JOIN nation ON n_nationkey = nk JOIN region ON r_regionkey = n_regionkey
  WHERE b > 0),
typed AS (
  SELECT order_id, status,
         TRY_CAST(NULLIF(ordered_at, '') AS TIMESTAMP) AS purchased_at,
         TRY_CAST(NULLIF(dispatched_at, '') AS TIMESTAMP) AS shipped_at,
         TRY_CAST(NULLIF(received_at, '') AS TIMESTAMP) AS delivered_at,
         TRY_CAST(NULLIF(promised_at, '') AS TIMESTAMP) AS promised_at
  FROM raw_orders),
stg_orders AS (
  SELECT order_id, purchased_at, delivered_at, promised_at,
         CAST(purchased_at AS DATE) AS purchase_date,
         CAST(date_trunc('week', purchased_at) AS DATE) AS purchase_week,
         CAST(CAST(delivered_at AS DATE) - CAST(purchased_at AS DATE) AS INTEGER) AS observed_fulfil_days,
         CAST(CAST(promised_at AS DATE) - CAST(purchased_at AS DATE) AS INTEGER) AS promised_fulfil_days
  FROM typed
  WHERE status = '{CFG.completed_status}' AND delivered_at IS NOT NULL
    AND (shipped_at IS NULL OR delivered_at >= shipped_at)
    AND delivered_at > purchased_at AND purchased_at >= TIMESTAMP '{CFG.start_date}'),
stg_products AS (
  SELECT product_id, coalesce(NULLIF(p.category, ''), 'unknown') AS category_src,
         coalesce(NULLIF(label, ''), NULLIF(p.category, ''), 'unknown') AS category
  FROM raw_products p LEFT JOIN raw_labels t ON t.category = p.category),
stg_items AS (
  SELECT order_id, line_no AS item_seq, product_id, supplier_id AS seller_id,
         TRY_CAST(NULLIF(unit_value, '') AS DECIMAL(18,4)) AS price,
         TRY_CAST(coalesce(NULLIF(quantity, ''), '1') AS DECIMAL(18,4)) AS qty
  FROM raw_lines),
stg_sellers AS (SELECT supplier_id AS seller_id, city, region AS state FROM raw_suppliers)"""

def filled(c: str, type_: str) -> str:
    return f"CAST(coalesce({c}, 0) AS {type_}) AS {c}"


MARTS = f"""
facts AS (
  SELECT o.order_id, i.item_seq, i.product_id, p.category, i.seller_id, o.purchase_date, o.purchase_week,
         CAST(o.delivered_at AS DATE) AS delivered_date, o.observed_fulfil_days, o.promised_fulfil_days,
         i.price, i.qty
  FROM stg_orders o JOIN stg_items i ON i.order_id = o.order_id
  JOIN stg_products p ON p.product_id = i.product_id),
sales AS (
  SELECT category, seller_id, purchase_week, sum(qty) AS units, sum(price * qty) AS revenue
  FROM facts GROUP BY 1, 2, 3),
calendar AS (
  SELECT CAST(unnest(generate_series(min(purchase_week), greatest(max(purchase_week), DATE '{CALC_DATE}'),
                                     INTERVAL 7 DAY)) AS DATE) AS purchase_week FROM sales),
extents AS (
  SELECT category, seller_id, min(purchase_week) AS first_week, max(purchase_week) AS last_week,
         count(*) AS sale_weeks, sum(units) AS sold
  FROM sales GROUP BY ALL),
modelled AS (
  SELECT * FROM extents WHERE sale_weeks >= {CFG.min_weeks_history} AND sold >= {CFG.min_units_history}),
spine AS (
  SELECT category, seller_id, purchase_week FROM calendar
  JOIN modelled ON purchase_week BETWEEN first_week AND last_week),
fct AS (
  SELECT category, seller_id, purchase_week, {filled("units", "DECIMAL(18,4)")}, {filled("revenue", "DECIMAL(38,8)")}
  FROM spine LEFT JOIN sales USING (category, seller_id, purchase_week))"""


def _duration_stats(source: str, keys: str) -> str:
    """Half-up rounding to 3 and 4 places by integer division."""

    def mean(c: str) -> str:
        return f"CAST((2000 * sum({c}) + count({c})) // (2 * count({c})) AS DOUBLE) / 1000"

    late = "count(*) FILTER (WHERE observed_fulfil_days > promised_fulfil_days)"
    return f"""
  SELECT {keys}, count(*) AS n_deliveries,
         {mean("observed_fulfil_days")} AS observed_mean_days,
         round(coalesce(stddev_samp(observed_fulfil_days), 0), 3) AS observed_sd_days,
         {mean("promised_fulfil_days")} AS promised_mean_days,
         round(coalesce(stddev_samp(promised_fulfil_days), 0), 3) AS promised_sd_days,
         CAST((20000 * {late} + count(*)) // (2 * count(*)) AS DOUBLE) / 10000 AS pct_late
  FROM {source} GROUP BY ALL HAVING count(*) >= {CFG.min_deliveries}"""


def _dates(days) -> str:
    return ", ".join(f"(DATE '{d}')" for d in days)


def _dated_marts(days) -> str:
    """The marts once per date: fact up to the date, statistics over all history."""
    return f"""
dates AS (SELECT * FROM (VALUES {_dates(days)}) v(calc_date)),
fulfil AS ({_duration_stats("facts", "category, seller_id")}),
fct_d AS (SELECT calc_date, fct.* FROM fct JOIN dates ON purchase_week <= calc_date),
fulfil_d AS (SELECT calc_date, fulfil.* FROM fulfil, dates)"""


def _dated_marts_as_of(days) -> str:
    """The marts rebuilt for each date from the lines bought and received by it."""
    return f"""
dates AS (SELECT * FROM (VALUES {_dates(days)}) v(calc_date)),
facts_d AS (SELECT calc_date, facts.* FROM facts
  JOIN dates ON delivered_date <= calc_date AND purchase_date <= calc_date),
sales_d AS (
  SELECT calc_date, category, seller_id, purchase_week, sum(qty) AS units, sum(price * qty) AS revenue
  FROM facts_d GROUP BY 1, 2, 3, 4),
modelled_d AS (
  SELECT calc_date, category, seller_id, min(purchase_week) AS first_week, max(purchase_week) AS last_week
  FROM sales_d GROUP BY ALL
  HAVING count(*) >= {CFG.min_weeks_history} AND sum(units) >= {CFG.min_units_history}),
fct_d AS (
  SELECT calc_date, category, seller_id, purchase_week, {filled("units", "DECIMAL(18,4)")},
         {filled("revenue", "DECIMAL(38,8)")}
  FROM (SELECT m.calc_date, category, seller_id, purchase_week FROM modelled_d m
        JOIN calendar ON purchase_week BETWEEN first_week AND last_week)
  LEFT JOIN sales_d USING (calc_date, category, seller_id, purchase_week)),
fulfil_d AS ({_duration_stats("facts_d", "calc_date, category, seller_id")})"""


Z = " ".join(f"WHEN {level} THEN {Z_VALUES[level]!r}" for level in CFG.service_levels.values())
PCT = f"{CFG.intermittency_threshold:.0%}"
STALE_WEEKS = CFG.activity_window_weeks


def _params(cover: float = CFG.baseline_weeks_of_cover) -> str:
    weeks = CFG.demand_window_weeks
    days = [f"{s}_{m}_days" for s in ("promised", "observed") for m in ("mean", "sd")]
    stock = [f"{k}_{s}" for k in ("cycle", "ss", "rop") for s in ("promised", "observed")]
    means = ", ".join(f"avg({c}) AS {c}" for c in days)
    sums = ", ".join(f"sum({c}) AS {c}" for c in stock)
    ranges = ", ".join(
        f"{f} AS {name}_share"
        for name, f in (
            ("min", "min(supply_variance_share)"),
            ("mid", "quantile_cont(supply_variance_share, 0.5)"),
            ("max", "max(supply_variance_share)"),
        )
    )
    return f"""
window_d AS (SELECT * FROM fct_d WHERE purchase_week > calc_date - {7 * weeks}),
stats AS (
  SELECT calc_date, category, seller_id, count(units) AS weeks, avg(CAST(units AS DOUBLE)) AS demand_mean,
         coalesce(stddev_samp(CAST(units AS DOUBLE)), 0) AS demand_sd,
         avg(CASE WHEN units = 0 THEN 1.0 ELSE 0.0 END) AS zero_week_share,
         sum(revenue) AS window_revenue,
         CAST(sum(revenue) AS DOUBLE) / {weeks} * 52 AS annualised_revenue
  FROM window_d GROUP BY 1, 2, 3),
activity AS (
  SELECT calc_date, category, seller_id, max(purchase_week) FILTER (WHERE units > 0) AS last_sale_week
  FROM fct_d GROUP BY 1, 2, 3),
joined AS (
  SELECT s.*, CASE WHEN demand_mean > 0 THEN demand_sd / demand_mean END AS cv, last_sale_week,
         f.* EXCLUDE (calc_date, category, seller_id),
         round((calc_date - last_sale_week) / 7.0, 1) AS weeks_since_last_sale,
         CAST(annualised_revenue AS DECIMAL(28,6)) AS amount
  FROM stats s JOIN fulfil_d f USING (calc_date, category, seller_id)
  LEFT JOIN activity a USING (calc_date, category, seller_id)),
shares AS (
  SELECT *, CAST(sum(amount) OVER w AS DOUBLE) / NULLIF(CAST(sum(amount) OVER (PARTITION BY calc_date) AS DOUBLE), 0)
              AS share_upto,
         CAST(sum(amount) OVER w - amount AS DOUBLE)
           / NULLIF(CAST(sum(amount) OVER (PARTITION BY calc_date) AS DOUBLE), 0) AS cum_share_before
  FROM joined WINDOW w AS (PARTITION BY calc_date ORDER BY annualised_revenue DESC, category, seller_id
                           ROWS UNBOUNDED PRECEDING)),
classed AS (
  SELECT *, coalesce(share_upto, 0) AS cum_share,
         CASE WHEN cum_share_before < {CFG.abc_thresholds["A"]} THEN 'A'
              WHEN cum_share_before < {CFG.abc_thresholds["B"]} THEN 'B' ELSE 'C' END AS abc,
         CASE WHEN cv <= {CFG.xyz_thresholds["X"]} THEN 'X'
              WHEN cv <= {CFG.xyz_thresholds["Y"]} THEN 'Y' ELSE 'Z' END AS xyz,
         coalesce(weeks_since_last_sale > {STALE_WEEKS}, FALSE) AS is_stale,
         zero_week_share > {CFG.intermittency_threshold} AS is_intermittent
  FROM shares),
levels AS (
  SELECT *, CASE abc WHEN 'A' THEN {CFG.service_levels["A"]} WHEN 'B' THEN {CFG.service_levels["B"]}
                     ELSE {CFG.service_levels["C"]} END AS service_level FROM classed),
terms AS (
  SELECT *, CASE service_level {Z} END AS z,
         observed_mean_days / 7.0 AS observed_weeks, promised_mean_days / 7.0 AS promised_weeks,
         observed_mean_days / 7.0 * demand_sd * demand_sd AS observed_demand_term,
         promised_mean_days / 7.0 * demand_sd * demand_sd AS promised_demand_term,
         demand_mean * demand_mean * (observed_sd_days / 7.0) * (observed_sd_days / 7.0) AS observed_supply_term,
         demand_mean * demand_mean * (promised_sd_days / 7.0) * (promised_sd_days / 7.0) AS promised_supply_term
  FROM levels),
stock AS (
  SELECT *, z * sqrt(observed_demand_term + observed_supply_term) AS ss_observed,
         z * sqrt(promised_demand_term + promised_supply_term) AS ss_promised,
         demand_mean * observed_weeks AS cycle_observed, demand_mean * promised_weeks AS cycle_promised
  FROM terms),
params AS (
  SELECT *, cycle_observed + ss_observed AS rop_observed, cycle_promised + ss_promised AS rop_promised,
         cycle_observed + ss_observed AS model_total_target, demand_mean * {cover} AS naive_total_cover,
         CASE WHEN observed_demand_term + observed_supply_term > 0
              THEN observed_supply_term / (observed_demand_term + observed_supply_term) END
           AS supply_variance_share,
         NOT (is_intermittent OR is_stale) AS is_publishable,
         CASE WHEN is_intermittent AND is_stale
                THEN 'intermittent (>{PCT} zero weeks) and no sale in {STALE_WEEKS}+ weeks'
              WHEN is_intermittent
                THEN 'intermittent demand: >{PCT} zero weeks, normal model invalid'
              WHEN is_stale THEN 'stale: no sale within {STALE_WEEKS} weeks of calc_date' END
           AS exclusion_reason
  FROM stock),
live AS (SELECT * FROM params WHERE is_publishable),
overall AS (
  SELECT count(*) AS n, {means}, {sums}, {ranges},
         avg(promised_mean_days / NULLIF(observed_mean_days, 0)) AS pad,
         count(*) FILTER (promised_mean_days > observed_mean_days) AS n_padded,
         count(*) FILTER (naive_total_cover < model_total_target) AS n_short,
         count(*) FILTER (supply_variance_share > 0.5) AS n_supply,
         100 * (sum(rop_promised) / sum(rop_observed) - 1) AS overstated
  FROM live),
per_class AS (
  SELECT abc, xyz, count(*) AS n, sum(naive_total_cover) AS naive, sum(model_total_target) AS model,
         avg(supply_variance_share) AS supply, count(*) FILTER (naive_total_cover < model_total_target) AS n_under,
         count(*) FILTER (naive_total_cover > model_total_target) AS n_over
  FROM live GROUP BY ALL)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


def num(*cols: str) -> str:
    """Columns (or `expr AS name`) as doubles rounded to six places."""
    out = []
    for c in cols:
        expr, _, name = c.rpartition(" AS ")
        out.append(f"ROUND(CAST({expr or name} AS DOUBLE), 6) AS {name}")
    return ", ".join(out)


def big(*cols: str) -> str:
    out = []
    for c in cols:
        expr, _, name = c.rpartition(" AS ")
        out.append(f"CAST({expr or name} AS BIGINT) AS {name}")
    return ", ".join(out)


def rounded(digits: int, **names: str) -> str:
    """Keys are expressions, values their names."""
    return ", ".join(f"round({expr}, {digits}) AS {name}" for expr, name in names.items())


def stamp(*cols: str) -> str:
    return ", ".join(f"strftime({c}, {FMT}) AS {c}" for c in cols)


def half_up_pct(part: str, whole: str, digits: int) -> str:
    scale = 10**digits
    return f"CAST((200 * {scale} * {part} + {whole}) // (2 * {whole}) AS DOUBLE) / {scale}"


DURATIONS = num(
    "observed_mean_days", "observed_sd_days", "promised_mean_days", "promised_sd_days", "pct_late"
)
POLICY_NUMBERS = num(
    "ss_observed",
    "ss_promised",
    "naive_total_cover",
    "model_total_target",
    "cycle_observed",
    "cycle_promised",
    "rop_observed",
    "supply_variance_share",
    "weeks_since_last_sale",
)
PUBLISHED = f"""calc_date, category, seller_id, abc, xyz,
  {num("service_level", "demand_mean", "demand_sd", "zero_week_share")}, {DURATIONS}, {POLICY_NUMBERS},
  is_intermittent, is_stale, is_publishable, exclusion_reason"""

REASONS = [
    ("status is not the completed status", f"status <> '{CFG.completed_status}'"),
    (
        f"status={CFG.completed_status} but delivery timestamp null",
        f"status = '{CFG.completed_status}' AND coalesce(received_at, '') = ''",
    ),
    (
        "delivered before dispatched (timestamp violation)",
        "received_at <> '' AND dispatched_at <> '' AND TRY_CAST(received_at AS TIMESTAMP)"
        " < TRY_CAST(dispatched_at AS TIMESTAMP)",
    ),
    (
        f"purchased before {CFG.start_date}",
        f"status = '{CFG.completed_status}' AND TRY_CAST(ordered_at AS TIMESTAMP)"
        f" < DATE '{CFG.start_date}'",
    ),
]


def _least_consistent(n: int) -> str:
    return f"""top AS (
  SELECT * FROM live WHERE abc IN ('A', 'B')
  ORDER BY observed_sd_days DESC, category, seller_id LIMIT {n})"""


def oracle_sql() -> dict[str, str]:
    staging = _with(STAGING)
    marts = _with(STAGING, MARTS)
    one = (STAGING, MARTS, _dated_marts([CALC_DATE]), _params())
    params = _with(*one)
    two = (STAGING, MARTS, _dated_marts([PREVIOUS_DATE, CALC_DATE]), _params())
    many = (STAGING, MARTS, _dated_marts(HISTORY_DATES), _params())
    as_of = (STAGING, MARTS, _dated_marts_as_of(HISTORY_DATES), _params())
    key = "category, seller_id"
    window = f"purchase_week <= DATE '{CALC_DATE}' AND purchase_week > DATE '{CALC_DATE}' - {7 * CFG.demand_window_weeks}"
    q: dict[str, str] = {}

    # Sources
    q["canonical_orders"] = staging + "SELECT * FROM raw_orders"
    q["canonical_order_lines"] = staging + (
        "SELECT order_id, line_no, product_id, supplier_id, unit_value, CAST(NULL AS VARCHAR) AS quantity"
        " FROM raw_lines"
    )
    q["scan_mapped_csv"] = staging + "SELECT * FROM raw_lines"
    q["quarantine_lines"] = staging + """
SELECT 'raw.order_lines' AS table_name,
       order_id || ',1' || CASE WHEN CAST(order_id AS BIGINT) % 2 = 0 THEN '' ELSE ',x,S1,1.00,1,extra' END AS line
FROM raw_lines WHERE line_no = '1' AND CAST(order_id AS BIGINT) % 251 = 0"""
    q["layer_overwritten"] = staging + "SELECT * FROM raw_products"
    line_value = "coalesce(price * qty, 0)"
    q["line_value_share"] = staging + f"""
, ranked AS (SELECT *, price * qty AS line_value, {line_value} AS v,
    sum({line_value}) OVER (ORDER BY price * qty DESC NULLS LAST, order_id, item_seq ROWS UNBOUNDED PRECEDING) AS upto,
    sum({line_value}) OVER () AS total FROM stg_items)
SELECT order_id, item_seq, {num("line_value", "CAST(upto - v AS DOUBLE) / total AS cum_share_before",
                                "CAST(upto AS DOUBLE) / total AS cum_share")} FROM ranked"""
    q["seller_percentiles"] = staging + " UNION ALL ".join(
        f"SELECT seller_id, '{c}' AS \"column\", CAST({p} AS DOUBLE) AS p,"
        f" {num(f'quantile_cont(CAST({c} AS DOUBLE), {p}) AS value')}, count({c}) AS n FROM stg_items GROUP BY seller_id"
        for c in ("price", "qty") for p in (0.1, 0.5, 0.9)
    )
    q["raw_row_counts"] = staging + " UNION ALL ".join(
        f"SELECT 'raw.{name}' AS table_name, count(*) AS n_rows FROM {cte}"
        for name, cte in [
            ("orders", "raw_orders"),
            ("order_lines", "raw_lines"),
            ("products", "raw_products"),
            ("suppliers", "raw_suppliers"),
            ("category_labels", "raw_labels"),
        ]
    )

    # Staging
    q["typed_orders"] = staging + (
        f"SELECT order_id, status, {stamp('purchased_at', 'shipped_at', 'delivered_at', 'promised_at')}"
        " FROM typed"
    )
    bad = [("orders", "order_id", c, "TIMESTAMP", "raw_orders")
           for c in ("ordered_at", "received_at", "promised_at", "dispatched_at")]
    bad += [("order_lines", "order_id || '/' || line_no", c, "DECIMAL(18,4)", "raw_lines")
            for c in ("unit_value", "quantity")]
    q["quarantine_orders"] = staging + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {k} AS row_key, '{c}' AS column_name, {c} AS value FROM {cte}"
        f" WHERE {c} <> '' AND TRY_CAST({c} AS {ty}) IS NULL"
        for t, k, c, ty, cte in bad
    )
    q["staging_orders"] = staging + (
        f"SELECT order_id, {stamp('purchased_at', 'delivered_at', 'promised_at')}, purchase_date,"
        " purchase_week, observed_fulfil_days, promised_fulfil_days FROM stg_orders"
    )
    q["exclusions"] = staging + " UNION ALL ".join(
        f"SELECT 'staging.orders' AS step, '{name}' AS reason,"
        f" (SELECT count(*) FROM raw_orders WHERE {cond}) AS rows_removed"
        for name, cond in REASONS
    )
    q["exclusion_waterfall"] = staging + f"""
SELECT CASE WHEN status IS NULL THEN 'status missing'
            WHEN status <> '{CFG.completed_status}' THEN 'status is not the completed status'
            WHEN delivered_at IS NULL THEN 'no usable delivery timestamp'
            WHEN delivered_at < shipped_at THEN 'delivered before dispatched'
            WHEN purchased_at IS NULL THEN 'no usable order timestamp'
            WHEN delivered_at <= purchased_at THEN 'delivered not after purchased'
            WHEN purchased_at < DATE '{CFG.start_date}' THEN 'purchased before {CFG.start_date}'
            ELSE 'kept' END AS reason, count(*) AS orders
FROM typed GROUP BY 1"""
    q["staging_products"] = staging + "SELECT * FROM stg_products"
    q["staging_order_items"] = staging + (
        f"SELECT order_id, item_seq, product_id, seller_id, {num('price', 'qty')} FROM stg_items"
    )
    q["staging_sellers"] = staging + "SELECT * FROM stg_sellers"

    # Profile
    q["profile_status"] = staging + f"""
SELECT status, n, {half_up_pct("n", "CAST(sum(n) OVER () AS BIGINT)", 2)} AS pct
FROM (SELECT status, count(*) AS n FROM raw_orders GROUP BY 1)"""
    q["profile_nulls"] = staging + """
SELECT count(*) AS total_orders,
       count(*) FILTER (WHERE coalesce(received_at, '') = '') AS null_received,
       count(*) FILTER (WHERE coalesce(promised_at, '') = '') AS null_promised,
       count(*) FILTER (WHERE coalesce(dispatched_at, '') = '') AS null_dispatched FROM raw_orders"""
    q["profile_contradictions"] = staging + f"""
SELECT (SELECT count(*) FROM raw_orders WHERE {REASONS[1][1]}) AS completed_not_received,
       (SELECT count(*) FROM typed WHERE delivered_at < shipped_at) AS received_before_dispatched,
       (SELECT count(*) FROM typed WHERE delivered_at <= purchased_at) AS received_not_after_ordered"""
    q["profile_monthly"] = staging + """
SELECT strftime(purchased_at, '%Y-%m') AS ym, count(*) AS orders FROM typed GROUP BY 1 ORDER BY 1 LIMIT 8"""
    q["profile_uncategorised"] = staging + """
SELECT count(*) AS uncategorised_products FROM raw_products WHERE coalesce(category, '') = ''"""
    q["profile_product_thickness"] = staging + f"""
SELECT count(*) AS products_sold,
       CAST((200 * CAST(sum(n) AS BIGINT) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_lines,
       {num("quantile_cont(n, 0.5) AS median_lines")},
       count(*) FILTER (WHERE n = 1) AS sold_exactly_once, count(*) FILTER (WHERE n >= 20) AS sold_20_or_more
FROM (SELECT product_id, count(*) AS n FROM raw_lines GROUP BY 1)"""

    q["profile_duplicate_keys"] = staging + " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{k}' AS key, count(*) FILTER (n > 1) AS repeated_keys,"
        f" CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_rows"
        f" FROM (SELECT count(*) AS n FROM {cte} WHERE {k} IS NOT NULL GROUP BY {k})"
        for t, k, cte in [
            ("orders", "order_id", "raw_orders"),
            ("products", "product_id", "raw_products"),
            ("suppliers", "supplier_id", "raw_suppliers"),
            ("category_labels", "category", "raw_labels"),
        ]
    )
    q["line_value_percentile"] = staging + (
        f"SELECT {num('quantile_cont(CAST(price AS DOUBLE), 0.9) AS value')}, count(price) AS n FROM stg_items"
    )

    # Readiness
    q["readiness_unparseable"] = staging + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, (SELECT count(*) FROM raw_orders WHERE {c} IS NOT NULL"
        f" AND TRY_CAST({c} AS TIMESTAMP) IS NULL) AS unparseable"
        for c in ("ordered_at", "received_at", "promised_at")
    )
    q["readiness_status"] = staging + (
        "SELECT status, count(*) AS n FROM raw_orders WHERE status IS NOT NULL GROUP BY 1"
    )
    usable = f"""
ready AS (SELECT count(*) AS usable_orders,
       (date_diff('second', min(purchased_at), max(purchased_at)) // 86400) / 7.0 AS span_weeks,
       CAST(min(purchased_at) AS DATE) AS first_day, CAST(max(purchased_at) AS DATE) AS last_day
FROM typed WHERE status = '{CFG.completed_status}' AND delivered_at > purchased_at),
grain_p AS (SELECT quantile_cont(n, 0.5) AS median_lines, count(*) FILTER (WHERE n = 1) AS sold_exactly_once,
       count(*) AS products_sold FROM (SELECT l.product_id, count(*) AS n FROM raw_lines l
         LEFT JOIN raw_products p ON p.product_id = l.product_id GROUP BY 1)),
grain_s AS (SELECT count(*) FILTER (WHERE weeks >= {CFG.min_weeks_history}) AS viable_series
FROM (SELECT category, supplier_id, count(DISTINCT date_trunc('week', purchased_at)) AS weeks
      FROM raw_lines JOIN typed USING (order_id) JOIN raw_products USING (product_id)
      WHERE category IS NOT NULL GROUP BY 1, 2)),
verdict AS (SELECT CASE WHEN median_lines >= {CFG.min_lines_per_product} THEN 'product'
                        WHEN viable_series >= {CFG.min_viable_series} THEN 'category+supplier'
                        ELSE 'none' END AS grain, median_lines, viable_series FROM grain_p, grain_s)"""
    ready = _with(STAGING, usable)
    q["readiness_usable"] = ready + (
        f"SELECT usable_orders, {num('span_weeks')}, first_day, last_day FROM ready"
    )
    q["readiness_product_grain"] = ready + (
        f"SELECT {num('median_lines')}, sold_exactly_once, products_sold FROM grain_p"
    )
    q["readiness_series_grain"] = ready + "SELECT viable_series FROM grain_s"
    q["readiness_grain_verdict"] = ready + (
        f"SELECT grain, {num('median_lines')}, viable_series FROM verdict"
    )
    unparsed = " UNION ALL ".join(
        f"SELECT 'unparseable {c}' AS name, count(*) AS v FROM raw_orders"
        f" WHERE {c} IS NOT NULL AND TRY_CAST({c} AS TIMESTAMP) IS NULL"
        for c in ("ordered_at", "received_at", "promised_at")
    )
    q["input_readiness"] = ready + f"""
SELECT name AS "check", CASE WHEN v > 0 THEN 'WARN' ELSE 'OK' END AS level, {num("v AS value")},
       CAST(NULL AS VARCHAR) AS detail FROM ({unparsed})
UNION ALL SELECT 'completed status', CASE WHEN count(*) = 0 THEN 'FAIL' ELSE 'OK' END,
       CAST(count(*) AS DOUBLE),
       (SELECT string_agg(status, ', ' ORDER BY status) FROM
          (SELECT DISTINCT status FROM raw_orders WHERE status IS NOT NULL ORDER BY 1 LIMIT 8))
FROM raw_orders WHERE status = '{CFG.completed_status}'
UNION ALL SELECT 'usable orders', CASE WHEN usable_orders < {CFG.min_usable_orders} THEN 'FAIL' ELSE 'OK' END,
       usable_orders, NULL FROM ready
UNION ALL SELECT 'history weeks', CASE WHEN span_weeks < {CFG.min_span_weeks} THEN 'WARN' ELSE 'OK' END,
       round(span_weeks, 6), CAST(first_day AS VARCHAR) || ' to ' || CAST(last_day AS VARCHAR)
FROM ready WHERE usable_orders > 0
UNION ALL SELECT 'median lines per product', 'OK', median_lines, NULL FROM grain_p
UNION ALL SELECT 'products sold exactly once', 'OK', sold_exactly_once, NULL FROM grain_p
UNION ALL SELECT 'products sold', 'OK', products_sold, NULL FROM grain_p
UNION ALL SELECT 'viable series', CASE WHEN grain = 'none' THEN 'FAIL' ELSE 'OK' END, viable_series, grain
FROM verdict"""

    # Marts
    q["order_line_facts"] = marts + f"""
SELECT order_id, item_seq, product_id, {key}, purchase_date, purchase_week, delivered_date,
       observed_fulfil_days, promised_fulfil_days, {num("price", "qty")} FROM facts"""
    q["weekly_sales"] = marts + f"SELECT {key}, purchase_week, {num('units', 'revenue')} FROM sales"
    q["modelled_series"] = marts + f"SELECT {key}, first_week, last_week FROM modelled"
    q["calendar_spine"] = marts + f"SELECT {key}, purchase_week FROM spine"
    q["fct_demand_weekly"] = marts + f"SELECT {key}, purchase_week, {num('units', 'revenue')} FROM fct"
    q["fct_demand_to_calc_date"] = marts + f"""
SELECT {key}, purchase_week, {num("coalesce(units, 0) AS units", "coalesce(revenue, 0) AS revenue")}
FROM (SELECT {key}, purchase_week FROM modelled JOIN calendar ON purchase_week >= first_week
       AND purchase_week <= greatest(last_week, DATE '{CALC_DATE}'))
LEFT JOIN sales USING (category, seller_id, purchase_week)"""
    q["fulfilment_stats"] = params + f"SELECT {key}, n_deliveries, {DURATIONS} FROM fulfil"
    starts = " ".join(
        f"WHEN purchase_date >= DATE '{d}' THEN DATE '{d}'" for d in reversed(CFG.period_starts)
    )
    q["dim_seller"] = marts + f"""
, days AS (SELECT seller_id, CASE {starts} ELSE DATE '{CFG.period_starts[0]}' END AS since,
                  observed_fulfil_days AS d FROM stg_orders JOIN stg_items USING (order_id)),
spans AS (SELECT seller_id, since, CAST((200 * sum(d) + count(d)) // (2 * count(d)) AS DOUBLE) / 100 AS mean_days
          FROM days GROUP BY ALL),
ends AS (SELECT a.seller_id, a.since, min(b.since) AS next_since FROM spans a
         LEFT JOIN spans b ON a.seller_id = b.seller_id AND b.since > a.since GROUP BY ALL)
SELECT seller_id, state, city, mean_days AS avg_fulfil_days, since AS valid_from,
       CAST(next_since - 1 AS DATE) AS valid_to, next_since IS NULL AS is_current
FROM spans JOIN ends USING (seller_id, since) LEFT JOIN stg_sellers USING (seller_id)"""
    hash_ = "('0x' || left(md5(coalesce(seller_id, '') || '|' || CAST(valid_from AS VARCHAR)), 15))"
    q["dim_seller_keys"] = q["dim_seller"].replace(
        "\nSELECT seller_id, state", "\n, dim AS (SELECT seller_id, state"
    ) + f") SELECT CAST({hash_} AS BIGINT) AS seller_key, * FROM dim"

    # Series statistics
    q["trailing_demand"] = marts + (
        f"SELECT {key}, purchase_week, {num('units', 'revenue')} FROM fct WHERE {window}"
    )
    q["demand_stats"] = params + (
        f"SELECT {key}, weeks, {num('demand_mean', 'demand_sd', 'zero_week_share')},"
        f" {num('CASE WHEN demand_mean > 0 THEN demand_sd / demand_mean END AS cv')} FROM stats"
    )
    q["series_activity"] = params + f"SELECT {key}, last_sale_week FROM activity"
    q["annualised_revenue"] = params + (
        f"SELECT {key}, {num('window_revenue', 'annualised_revenue')} FROM stats"
    )

    # Segmentation
    q["cumulative_revenue_share"] = params + (
        f"SELECT {key}, {num('annualised_revenue', 'cum_share_before', 'cum_share')} FROM params"
    )
    q["abc_classes"] = params + f"SELECT {key}, {num('cum_share')}, abc FROM params"
    q["xyz_classes"] = params + f"SELECT {key}, {num('cv')}, xyz FROM params"

    # Policy
    q["series_freshness"] = params + (
        f"SELECT {key}, last_sale_week, {num('weeks_since_last_sale')}, is_stale FROM params"
    )
    q["z_factors"] = params + f"SELECT {key}, abc, {num('service_level', 'z')} FROM params"
    q["safety_stock"] = params + f"SELECT {key}, {num('ss_observed', 'ss_promised')} FROM params"
    q["reorder_point"] = params + (
        f"SELECT {key}, {num('cycle_observed', 'cycle_promised', 'rop_observed', 'rop_promised')} FROM params"
    )
    terms = ("observed_demand_term", "observed_supply_term", "promised_demand_term", "promised_supply_term")
    q["variance_decomposition"] = params + (
        f"SELECT {key}, {num(*terms, 'supply_variance_share')} FROM params"
    )
    q["flat_cover_baseline"] = params + (
        f"SELECT {key}, {num('naive_total_cover', 'model_total_target')} FROM params"
    )
    q["publishability"] = params + (
        f"SELECT {key}, {num('zero_week_share')}, is_intermittent, is_stale, is_publishable, exclusion_reason"
        " FROM params"
    )
    q["buffer_params"] = params + f"SELECT {PUBLISHED} FROM params"
    q["run_summary"] = params + """
SELECT count(*) AS computed, count(*) FILTER (WHERE is_publishable) AS publishable,
       count(*) FILTER (WHERE is_intermittent) AS intermittent, count(*) FILTER (WHERE is_stale) AS stale
FROM params"""
    q["buffer_params_history"] = _with(*many) + f"SELECT {PUBLISHED} FROM params"
    q["buffer_params_history_as_of"] = _with(*as_of) + f"SELECT {PUBLISHED} FROM params"

    q["readiness_overall"] = f"""
SELECT CASE WHEN count(*) FILTER (WHERE level = 'FAIL') > 0 THEN 'FAIL'
            WHEN count(*) FILTER (WHERE level = 'WARN') > 0 THEN 'WARN' ELSE 'OK' END AS verdict,
       count(*) FILTER (WHERE level = 'FAIL') AS failed, count(*) FILTER (WHERE level = 'WARN') AS warned
FROM ({q["input_readiness"]})"""
    q["stored_fact_window"] = marts + (
        f"SELECT category, seller_id, purchase_week, {num('units', 'revenue')} FROM fct"
        f" WHERE purchase_week BETWEEN DATE '{FACT_FROM}' AND DATE '{CALC_DATE}'"
    )

    # Gates and snapshots
    measures = f"""count(*) AS total, count(*) FILTER (WHERE is_publishable) AS published,
       count(*) FILTER (WHERE is_publishable AND ss_observed < 0) AS negative,
       count(*) FILTER (WHERE is_publishable AND (observed_mean_days <= 0
                        OR observed_mean_days > {CFG.max_duration_days})) AS out_of_range,
       coalesce(100.0 * count(*) FILTER (WHERE is_publishable AND ss_observed IS NULL)
                / NULLIF(count(*) FILTER (WHERE is_publishable), 0), 0) AS null_pct"""
    names = ("publishable series", "negative safety stock", "fulfilment duration out of range",
             "null parameters pct", "row count drop pct")
    drop = "CAST(n - total AS DOUBLE) / NULLIF(n, 0) * 100"
    rules = (
        ("published", "total", "TRUE"),
        ("negative", "0", "negative = 0"),
        ("out_of_range", "0", "out_of_range = 0"),
        ("null_pct", CFG.max_null_pct, f"null_pct < {CFG.max_null_pct}"),
        (drop, CFG.max_row_drop_pct, f"coalesce({drop} <= {CFG.max_row_drop_pct}, TRUE)"),
    )

    def gate_rows(first: str = "") -> str:
        """One row per gate of every row of c (its counts, and n rows before)."""
        return " UNION ALL ".join(
            f"""SELECT {first} '{name}' AS "check", {num(f"{v} AS value", f"{limit} AS threshold")}, {ok} AS passed
FROM c"""
            for name, (v, limit, ok) in zip(names, rules)
        )

    def gates(population: str, previous: str) -> str:
        return f"""
, pop AS ({population}),
c AS (SELECT {measures}, (SELECT count(*) FROM ({previous})) AS n FROM pop),
g AS ({gate_rows()})
SELECT * FROM g"""

    q["backfill_gates"] = _with(*many) + f"""
, c AS (SELECT calc_date, {measures}, lag(count(*)) OVER (ORDER BY calc_date) AS n
        FROM params GROUP BY calc_date)
{gate_rows("calc_date,")}"""

    current = f"SELECT * FROM params WHERE calc_date = DATE '{CALC_DATE}'"
    earlier = f"SELECT * FROM params WHERE calc_date = DATE '{PREVIOUS_DATE}'"
    q["quality_gates"] = _with(*two) + gates(current, earlier)
    q["volume_gate"] = (
        _with(*two) + gates(current + " AND is_publishable", current) + " WHERE \"check\" LIKE 'row%'"
    )
    q["snapshot_rows"] = _with(*two) + "SELECT calc_date, count(*) AS n_rows FROM params GROUP BY 1"
    strict = f"count(*) FILTER (WHERE observed_mean_days <= 0 OR observed_mean_days > {STRICT.max_duration_days})"
    q["closed_gates"] = params + f"""
SELECT 'fulfilment duration out of range' AS "check", CAST({strict} AS DOUBLE) AS value, 0.0::DOUBLE AS threshold,
       FALSE AS passed FROM params WHERE is_publishable HAVING {strict} > 0"""
    q["latest_snapshot"] = _with(*two) + (
        f"SELECT {PUBLISHED} FROM params WHERE calc_date = (SELECT max(calc_date) FROM params)"
    )
    rerun = f"CASE WHEN calc_date = DATE '{CALC_DATE}' AND abc = 'A' THEN demand_mean * 3 ELSE naive_total_cover END"
    snap = f"calc_date, {key}, abc, {num('ss_observed', rerun + ' AS naive_total_cover')}"
    q["snapshot_upsert"] = _with(*two) + f"SELECT {snap} FROM params"
    q["snapshot_replace"] = _with(*two) + (
        f"SELECT {snap} FROM params WHERE calc_date <> DATE '{CALC_DATE}' OR abc = 'A'"
    )

    # Findings
    q["finding_population"] = params + f"""
SELECT status, n, {half_up_pct("n", "CAST(sum(n) OVER () AS BIGINT)", 1)} AS pct
FROM (SELECT coalesce(exclusion_reason, 'PUBLISHED') AS status, count(*) AS n FROM params GROUP BY 1)"""
    q["finding_duration_gap"] = params + f"""
SELECT {rounded(1, promised_mean_days="promised_mean_d", observed_mean_days="observed_mean_d")},
       {rounded(2, promised_sd_days="promised_sd_d", observed_sd_days="observed_sd_d", pad="pad_ratio")},
       n_padded AS series_padded, n AS series FROM overall"""
    stock = {f"{k}_{s}": f"{k}_{s}" for k in ("cycle", "ss") for s in ("promised", "observed")}
    q["finding_inventory_position"] = params + f"""
SELECT {rounded(0, **stock, rop_promised="total_promised", rop_observed="total_observed")},
       {rounded(1, overstated="pct_overstated")} FROM overall"""
    shares = {"mid_share * 100": "median_pct_supply", "min_share * 100": "min_pct", "max_share * 100": "max_pct"}
    q["finding_variance_drivers"] = params + (
        f"SELECT {rounded(1, **shares)}, n_supply AS majority_supply_driven, n AS series FROM overall"
    )
    gap = {"(sum(naive) / sum(model) - 1) * 100": "gap_pct"}
    q["finding_flat_rule_gap"] = params + f"""
SELECT abc, {big("sum(n) AS series", "sum(n_under) AS under", "sum(n_over) AS over")}, {rounded(1, **gap)},
       {rounded(0, **{"sum(naive)": "naive_total", "sum(model)": "model_total"})} FROM per_class GROUP BY abc"""
    cells = ", ".join(f"coalesce(sum(n) FILTER (xyz = '{c}'), 0) AS {c.lower()}" for c in "XYZ")
    q["finding_abc_xyz_grid"] = params + (
        f"SELECT abc, {big('x', 'y', 'z', 'total')} FROM"
        f" (SELECT abc, {cells}, sum(n) AS total FROM per_class GROUP BY abc)"
    )
    since = {"max(weeks_since_last_sale)": "oldest_weeks_since_sale", "avg(weeks_since_last_sale)": "avg_weeks_since_sale"}
    q["finding_freshness"] = params + f"SELECT {rounded(1, **since)} FROM live"
    q["finding_least_consistent"] = params + "," + _least_consistent(8) + f"""
SELECT left(seller_id, 8) AS seller, category, abc, {num("observed_mean_days AS mean_d", "observed_sd_days AS sd_d")},
       CAST(round(CAST(pct_late AS DECIMAL(6,4)) * 100, 0) AS DOUBLE) AS pct_late, round(model_total_target, 0) AS target_units FROM top"""
    # The sd without the largest week follows from sums, without ranking.
    q["finding_outlier_sensitivity"] = params + f"""
, sums AS (SELECT {key}, count(*) AS n, sum(u) AS s, sum(u * u) AS ss, max(u) AS top
           FROM (SELECT {key}, CAST(units AS DOUBLE) AS u FROM fct) GROUP BY ALL),
sds AS (SELECT {key}, sqrt((n * ss - s * s) / (n * (n - 1))) AS sd_all,
               CASE WHEN n > 2 THEN sqrt(greatest((n - 1) * (ss - top * top) - (s - top) * (s - top), 0)
                                         / ((n - 1) * (n - 2))) END AS sd_rest FROM sums WHERE n > 1)
SELECT {rounded(1, **{"avg((1 - sd_rest / NULLIF(sd_all, 0)) * 100)": "pct_of_sigma_from_single_week"})}
FROM sds JOIN live USING (category, seller_id)"""
    q["ranked_weeks"] = marts + f"""
SELECT {key}, purchase_week, {num("units")},
       CAST(ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY units DESC, purchase_week) AS INTEGER) AS rn FROM fct"""
    q["review_grid"] = params + f"""
, scale AS (SELECT greatest(max(model), max(naive)) AS top FROM per_class)
SELECT abc, xyz, n AS series, {rounded(3, supply="supply_share")},
       {rounded(1, **{"model": "required", "naive": "naive", "(naive / model - 1) * 100": "gap_pct",
                      "model / top * 100": "required_bar", "naive / top * 100": "naive_bar"})}
FROM per_class, scale"""
    q["exported_review"] = q["review_grid"]
    q["exported_exclusions"] = f"SELECT *, TRUE AS recorded FROM ({q['exclusions']})"
    q["review_worst"] = params + "," + _least_consistent(10) + f"""
SELECT left(seller_id, 8) AS seller, replace(category, '_', ' ') AS category, abc,
       {num("observed_mean_days AS mean", "observed_sd_days AS sd")},
       CAST(round(CAST(pct_late AS DECIMAL(6,4)) * 100, 0) AS DOUBLE) AS late, round(model_total_target, 0) AS ss FROM top"""
    q["review_tiles"] = params + f"""
SELECT {rounded(2, pad="pad_ratio")}, n_short AS short_series, n AS series,
       {rounded(1, promised_mean_days="promised_mean_d", observed_mean_days="observed_mean_d",
                overstated="pct_overstated", **{"mid_share * 100": "median_pct_supply"})},
       {rounded(0, **{"min_share * 100": "min_pct", "max_share * 100": "max_pct"})} FROM overall"""
    return q
