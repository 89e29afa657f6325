"""DuckDB SQL that states each registered query independently of the Spark plans.

The statements are built from shared common table expressions; row distances are joins on
row numbers here, where the Spark plans use windows and arrays.
"""

from __future__ import annotations

from panelcast.config import FeatureSpec, model_features
from panelcast.operators.severe import history_columns
from panelcast.operators.signal import split_features
from panelcast.plans.columns import OUTPUTS, TABLES, sql_select
from panelcast.plans.warehouse import DIAGNOSTICS, HOLIDAYS, SPLIT

INF = float("inf")


def _dates(days) -> str:
    return ", ".join(f"DATE '{d}'" for d in days)


ORIGINS = _dates(SPLIT.validation_origins)
BASE_ORIGINS = _dates(SPLIT.baseline_origins)

PANEL = """
a AS (
  SELECT l_suppkey AS store_nbr, l_returnflag AS family, CAST(l_shipdate AS DATE) AS date,
         SUM(l_quantity) AS sales,
         CAST(SUM(CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS onpromotion
  FROM lineitem
  GROUP BY 1, 2, 3),
k AS (SELECT DISTINCT store_nbr, family FROM a),
c AS (SELECT CAST(UNNEST(generate_series(CAST(MIN(date) AS TIMESTAMP), CAST(MAX(date) AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
        AS date FROM a),
panel AS (
  SELECT k.store_nbr, k.family, c.date, COALESCE(a.sales, CAST(0 AS DOUBLE)) AS sales,
         COALESCE(a.onpromotion, 0) AS onpromotion
  FROM k CROSS JOIN c
  LEFT JOIN a ON a.store_nbr = k.store_nbr AND a.family = k.family AND a.date = c.date)"""

STORES = """
stores AS (
  SELECT s_suppkey AS store_nbr, CONCAT('CITY_', CAST(s_nationkey % 10 AS VARCHAR)) AS city, r_name AS state,
         CASE s_nationkey % 10 % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS store_type,
         s_nationkey % 10 % 4 + 1 AS store_cluster
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

HOLIDAY_TABLE = f"""
holidays AS (
  SELECT CAST(d AS DATE) AS date, type, locale, locale_name, description, transferred
  FROM (VALUES {HOLIDAYS}) AS t(d, type, locale, locale_name, description, transferred)),
observed AS (SELECT * FROM holidays WHERE type = 'Holiday' AND NOT transferred)"""

DAILY = "daily AS (SELECT date, SUM(sales) AS sales FROM panel GROUP BY date)"


def _window_columns() -> str:
    parts = [f"LAG(sales, {k}) OVER s AS lag_{k}" for k in (7, 14, 28, 365)]
    for n in (7, 14, 28):
        frame = f"OVER (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        parts.append(f"CASE WHEN COUNT(sales) {frame} = {n} THEN AVG(sales) {frame} END AS rolling_mean_{n}")
        parts.append(f"CASE WHEN COUNT(sales) {frame} = {n} THEN STDDEV_SAMP(sales) {frame} END AS rolling_std_{n}")
    return ",\n         ".join(parts)


FEATURES = f"""
w AS (
  SELECT *, ROW_NUMBER() OVER s AS rn, {_window_columns()}
  FROM panel WINDOW s AS (PARTITION BY store_nbr, family ORDER BY date)),
x AS (
  SELECT *, rolling_std_28 / (rolling_mean_28 + 1e-6) AS rolling_cv_28,
         rolling_mean_7 - rolling_mean_28 AS momentum_7_28,
         rolling_mean_14 - rolling_mean_28 AS momentum_14_28,
         rolling_mean_7 / (rolling_mean_28 + 1e-6) AS trend_7_28,
         rolling_mean_28 / (lag_365 + 1e-6) AS yearly_ratio,
         CASE WHEN sales > rolling_mean_28 + 2 * rolling_std_28 THEN 1 ELSE 0 END AS is_spike_day
  FROM w),
f AS (
  SELECT *, CASE WHEN COUNT(*) OVER e >= 30 THEN AVG(is_spike_day) OVER e END AS historical_spike_rate
  FROM x WINDOW e AS (PARTITION BY store_nbr, family ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""

_ORIGIN_COLUMNS = FeatureSpec().origin_columns


def direct_cte(where: str, horizons: str = "1, 16", future: bool = False) -> str:
    """Direct rows by joining the panel to itself on row numbers; ``future`` keeps those without a target."""
    lags = "".join(
        f"""
  LEFT JOIN w l{k} ON l{k}.store_nbr = f.store_nbr AND l{k}.family = f.family
       AND l{k}.rn = f.rn + h.horizon - {k} AND h.horizon <= {k}"""
        for k in (7, 14, 28, 365)
    )
    needed = " AND ".join(
        [f"f.{c} IS NOT NULL" for c in _ORIGIN_COLUMNS]
        + (["TRUE"] if future else ["t.sales IS NOT NULL"])
        + ["l28.sales IS NOT NULL", "l365.sales IS NOT NULL"]
        + [f"(l{k}.sales IS NOT NULL OR h.horizon > {k})" for k in (7, 14)]
    )
    return f"""
d AS MATERIALIZED (
  SELECT f.store_nbr, f.family, st.store_type, st.city, st.state, st.store_cluster, f.date,
         f.sales AS origin_sales, {", ".join("f." + c for c in _ORIGIN_COLUMNS)},
         h.horizon, t.sales AS target, t.onpromotion AS target_onpromotion,
         l7.sales AS lag_7, l14.sales AS lag_14, l28.sales AS lag_28, l365.sales AS lag_365,
         f.date + CAST(h.horizon AS INTEGER) AS target_date,
         ISODOW(f.date + CAST(h.horizon AS INTEGER)) - 1 AS day_of_week,
         MONTH(f.date + CAST(h.horizon AS INTEGER)) AS month
  FROM f CROSS JOIN range({horizons}) h(horizon)
  {"LEFT JOIN" if future else "JOIN"} w t ON t.store_nbr = f.store_nbr AND t.family = f.family AND t.rn = f.rn + h.horizon{lags}
  LEFT JOIN stores st ON st.store_nbr = f.store_nbr
  WHERE {needed} AND {where})"""


SCORED = "scored AS (SELECT *, GREATEST(rolling_mean_28, lag_28) AS prediction FROM d)"
TAIL = f"""
tail AS (
  SELECT *, prediction - target AS error, ABS(prediction - target) AS absolute_error,
         prediction / NULLIF(target, 0) AS prediction_ratio
  FROM scored WHERE target > {DIAGNOSTICS.tail_threshold}),
severe AS (SELECT * FROM tail WHERE prediction_ratio < 0.5),
well AS (SELECT * FROM tail WHERE prediction_ratio BETWEEN 0.75 AND 1.25)"""
ERRORS = "errors AS (SELECT *, prediction - target AS error, ABS(prediction - target) AS absolute_error FROM scored)"

BASE = [PANEL]
FEATURED = [PANEL, FEATURES]
VALID = [PANEL, FEATURES, STORES, direct_cte(f"f.date IN ({ORIGINS})")]
EVERY = [PANEL, FEATURES, STORES, direct_cte("TRUE")]
SCORES = [*VALID, SCORED]
TAILS = [*SCORES, TAIL]
ERRS = [*SCORES, ERRORS]


def metrics(scale: str = "1", target: str = "target", prediction: str = "prediction") -> str:
    err = f"({prediction} - {target})"
    missing = f"COUNT(*) - COUNT({err})"
    guard = f"CASE WHEN {missing} = 0 THEN"
    return (
        f"COUNT(*) AS count, {guard} AVG(ABS{err}) END AS mae, {guard} SQRT(AVG({err} * {err})) END AS rmse, "
        f"{guard} SUM(ABS{err}) / NULLIF(SUM(ABS({target})), 0) * {scale} END AS wape, {missing} AS n_null"
    )


TAIL_METRICS = metrics("100") + ", AVG(error) AS mean_error, AVG(prediction_ratio) AS mean_ratio"


def bins(column: str, edges, labels) -> tuple[str, str]:
    """CASE expressions for the label and the position of right-closed bins."""
    tests = []
    for low, high in zip(edges[:-1], edges[1:]):
        parts = [f"{column} > {low}"] if low != -INF else []
        parts += [f"{column} <= {high}"] if high != INF else []
        tests.append(" AND ".join(parts) or f"{column} IS NOT NULL")
    label = "CASE " + " ".join(f"WHEN {t} THEN '{name}'" for t, name in zip(tests, labels)) + " END"
    order = "CASE " + " ".join(f"WHEN {t} THEN {i}" for i, t in enumerate(tests)) + " END"
    return label, order


SPIKE = bins("target", DIAGNOSTICS.spike_edges, DIAGNOSTICS.spike_labels)
LEVEL = bins("target", DIAGNOSTICS.level_edges, DIAGNOSTICS.level_labels)
COVERAGE = bins("prediction_ratio", DIAGNOSTICS.coverage_edges, DIAGNOSTICS.coverage_labels)

SEASONAL = f"""
origins AS (SELECT UNNEST([{BASE_ORIGINS}]) AS origin),
reference AS (
  SELECT origin, store_nbr, family, ISODOW(date) AS dow, ARG_MAX(sales, date) AS prediction
  FROM panel JOIN origins ON date <= origin WHERE sales IS NOT NULL GROUP BY 1, 2, 3, 4),
seasonal AS (
  SELECT o.origin, p.store_nbr, p.family, p.date AS target_date, p.date - o.origin AS horizon,
         p.sales AS target, r.prediction
  FROM panel p JOIN origins o ON p.date > o.origin AND p.date <= o.origin + 15
  LEFT JOIN reference r ON r.origin = o.origin AND r.store_nbr = p.store_nbr AND r.family = p.family
       AND r.dow = ISODOW(p.date))"""
NAIVE = "naive AS (SELECT *, origin_sales AS prediction FROM d)"
NAIVES = [PANEL, FEATURES, STORES, direct_cte(f"f.date IN ({BASE_ORIGINS})"), NAIVE]


def severe_by(column: str, alias: str | None = None) -> str:
    return f"""
SELECT {column} AS {alias or column}, COUNT(*) FILTER (WHERE prediction_ratio < 0.5) AS severe_count,
       COUNT(*) AS tail_count,
       COUNT(*) FILTER (WHERE prediction_ratio < 0.5) * 100.0 / COUNT(*) AS severe_rate,
       AVG(prediction_ratio) FILTER (WHERE prediction_ratio < 0.5) AS mean_ratio,
       AVG(error) FILTER (WHERE prediction_ratio < 0.5) AS mean_error
FROM tail GROUP BY 1 HAVING COUNT(*) FILTER (WHERE prediction_ratio < 0.5) > 0"""


MODEL_FEATURES = model_features()
NUMERIC, CATEGORICAL = split_features(MODEL_FEATURES)
HISTORY = history_columns(MODEL_FEATURES)


def compare(features, first: str, second: str, first_name: str, second_name: str) -> str:
    """One row per feature with mean and median of two populations."""
    rows = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, a.m AS {first_name}_mean, b.m AS {second_name}_mean, "
        f"a.d AS {first_name}_median, b.d AS {second_name}_median "
        f"FROM (SELECT AVG({f}) AS m, MEDIAN(CAST({f} AS DOUBLE)) AS d FROM {first}) a, "
        f"(SELECT AVG({f}) AS m, MEDIAN(CAST({f} AS DOUBLE)) AS d FROM {second}) b"
        for f in features
    )
    return rows


HISTORY_COMPARE = f"""
SELECT *, severe_mean - tail_mean AS mean_difference, severe_median - tail_median AS median_difference
FROM ({compare(HISTORY, "severe", "tail", "severe", "tail")})"""
NUMERIC_SIGNAL = f"""
SELECT *, severe_mean - well_mean AS mean_difference, severe_median - well_median AS median_difference,
       (severe_mean - well_mean) / NULLIF(well_mean, 0) * 100 AS relative_mean_difference_pct
FROM ({compare(NUMERIC, "severe", "well", "severe", "well")})"""
# the domain of each category: its levels in the training rows
TRAIN_LEVELS = f"""
train AS (SELECT DISTINCT f.store_nbr, f.family FROM f
          JOIN w t ON t.store_nbr = f.store_nbr AND t.family = f.family AND t.rn = f.rn + 1
          WHERE f.date BETWEEN DATE '{SPLIT.train_start}' AND DATE '{SPLIT.train_end}'
            AND f.yearly_ratio IS NOT NULL AND f.historical_spike_rate IS NOT NULL),
train_rows AS (SELECT train.*, st.store_type, st.city, st.state, st.store_cluster
               FROM train LEFT JOIN stores st USING (store_nbr)),
domain AS ({" UNION ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level FROM train_rows" for c in CATEGORICAL)})"""


def _levels(table: str, name: str) -> str:
    parts = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level FROM {table}" for c in CATEGORICAL)
    return (
        f"SELECT feature, level, COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (PARTITION BY feature) AS {name} "
        f"FROM ({parts}) GROUP BY 1, 2"
    )


CATEGORICAL_SIGNAL = f"""
SELECT feature, level, COALESCE(severe_pct, 0) AS severe_pct, COALESCE(well_pct, 0) AS well_pct,
       COALESCE(severe_pct, 0) - COALESCE(well_pct, 0) AS difference_pct
FROM domain FULL JOIN ({_levels("severe", "severe_pct")}) s USING (feature, level)
FULL JOIN ({_levels("well", "well_pct")}) v USING (feature, level)"""

HOLIDAY_FLAGS = """
flags AS (
  SELECT p.*, st.city, st.state, st.store_type, st.store_cluster,
    CASE WHEN p.date IN (SELECT date FROM observed WHERE locale = 'National')
           OR (p.date, st.state) IN (SELECT (date, locale_name) FROM observed WHERE locale = 'Regional')
           OR (p.date, st.city) IN (SELECT (date, locale_name) FROM observed WHERE locale = 'Local')
         THEN 1 ELSE 0 END AS is_holiday,
    CASE WHEN p.date IN (SELECT date FROM holidays WHERE description ILIKE '%Black Friday%')
         THEN 1 ELSE 0 END AS is_black_friday,
    CASE WHEN p.date IN (SELECT date FROM holidays WHERE description ILIKE '%Cyber Monday%')
         THEN 1 ELSE 0 END AS is_cyber_monday,
    CASE WHEN p.date IN (SELECT date FROM holidays WHERE description ILIKE '%Dia de la Madre%')
         THEN 1 ELSE 0 END AS is_mothers_day
  FROM panel p LEFT JOIN stores st USING (store_nbr))"""
FLAGGED = [PANEL, STORES, HOLIDAY_TABLE, HOLIDAY_FLAGS]
FLAGS = ("is_holiday", "is_black_friday", "is_cyber_monday", "is_mothers_day")

CONFIDENCE = """
limits AS (SELECT ROUND(QUANTILE_CONT(rolling_cv_28, 1.0 / 3), 9) AS low,
                  ROUND(QUANTILE_CONT(rolling_cv_28, 2.0 / 3), 9) AS high FROM scored),
labelled AS (
  SELECT scored.*, ABS(prediction - target) AS abs_error,
         CASE WHEN rolling_cv_28 IS NULL THEN 'unknown' WHEN ROUND(rolling_cv_28, 9) <= low THEN 'high'
              WHEN ROUND(rolling_cv_28, 9) <= high THEN 'medium' ELSE 'low' END AS prediction_confidence
  FROM scored CROSS JOIN limits)"""
LABELLED = [*SCORES, CONFIDENCE]

TAIL_LIST = "SELECT * FROM {source} ORDER BY {column}, store_nbr, family, date, horizon LIMIT {n}"


# reports of all slices in one table
ALL_ROWS = f"""
all_rows AS (
  SELECT *, prediction - target AS error, prediction / NULLIF(target, 0) AS prediction_ratio,
         target > {DIAGNOSTICS.tail_threshold} AS in_tail FROM labelled),
tail_rows AS (SELECT * FROM all_rows WHERE in_tail)"""
REPORT_SLICES = {
    "all": {},
    "all_by_horizon": {"horizon": "horizon"},
    "all_by_origin": {"origin": "date"},
    "all_by_origin_horizon": {"origin": "date", "horizon": "horizon"},
    "all_by_level": {"level": LEVEL[0], "level_order": LEVEL[1]},
    "all_by_tier": {
        "level": "NULLIF(prediction_confidence, 'unknown')",
        "level_order": "CASE prediction_confidence WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'low' THEN 2 END",
    },
    "tail": {},
    "tail_by_horizon": {"horizon": "horizon"},
    "tail_by_origin": {"origin": "date"},
    "tail_by_family": {"family": "family"},
    "tail_by_store": {"store_nbr": "store_nbr"},
    "tail_by_series": {"store_nbr": "store_nbr", "family": "family"},
    "tail_by_level": {"level": SPIKE[0], "level_order": SPIKE[1]},
    "tail_by_coverage": {"level": COVERAGE[0], "level_order": COVERAGE[1]},
}
REPORT_KEYS = {
    "origin": "DATE", "horizon": "BIGINT", "family": "VARCHAR", "store_nbr": "BIGINT", "level": "VARCHAR", "level_order": "BIGINT",
}


def _report_slice(source: str, name: str, keys: dict[str, str]) -> str:
    listed = ", ".join(f"CAST({keys.get(k, 'NULL')} AS {kind}) AS {k}" for k, kind in REPORT_KEYS.items())
    where = f"WHERE {keys['level']} IS NOT NULL" if "level" in keys else ""
    severe = "in_tail AND prediction_ratio < 0.5"
    well = "in_tail AND prediction_ratio BETWEEN 0.75 AND 1.25"
    promoted = "CASE WHEN target_onpromotion > 0 THEN 100.0 ELSE 0 END"
    return f"""
SELECT '{name}' AS slice, {", ".join(REPORT_KEYS)}, {metrics()}, AVG(error) AS mean_error, AVG(prediction_ratio) AS mean_ratio,
  COUNT(*) FILTER (WHERE in_tail) AS tail_count, SUM(target) FILTER (WHERE in_tail) AS tail_volume,
  COUNT(*) FILTER (WHERE in_tail AND prediction < target) AS under_count,
  COUNT(*) FILTER (WHERE in_tail AND prediction < 0.5 * target) AS severe_under_count,
  COUNT(*) FILTER (WHERE {severe}) AS severe_count, AVG(prediction_ratio) FILTER (WHERE {severe}) AS severe_mean_ratio,
  AVG(error) FILTER (WHERE {severe}) AS severe_mean_error, AVG({promoted}) FILTER (WHERE {severe}) AS severe_promotion_pct,
  COUNT(*) FILTER (WHERE {well}) AS well_count, AVG({promoted}) FILTER (WHERE {well}) AS well_promotion_pct
FROM (SELECT {listed}, target, prediction, error, prediction_ratio, in_tail, target_onpromotion FROM {source} {where}) rows
GROUP BY {", ".join(REPORT_KEYS)}"""


def _report_median(question: str, part: str, population: str, value: str, source: str) -> str:
    """One row per part that has values."""
    value = f"CAST({value} AS DOUBLE)"
    return (
        f"SELECT '{question}' AS question, {part} AS part, '{population}' AS population, COUNT({value}) AS n, "
        f"AVG({value}) AS mean, MEDIAN({value}) AS median, CAST(NULL AS DOUBLE) AS low, CAST(NULL AS DOUBLE) AS high "
        f"FROM {source} GROUP BY 1, 2, 3 HAVING COUNT({value}) > 0"
    )


REPORT_QUANTILES = " UNION ALL ".join(
    [
        "SELECT 'volatility' AS question, '' AS part, 'all' AS population, COUNT(rolling_cv_28) AS n, AVG(rolling_cv_28) AS mean, "
        "CAST(NULL AS DOUBLE) AS median, QUANTILE_CONT(rolling_cv_28, 1.0 / 3) AS low, QUANTILE_CONT(rolling_cv_28, 2.0 / 3) AS high "
        "FROM scored HAVING COUNT(rolling_cv_28) > 0",
        _report_median("error", "''", "all", "(prediction - target)", "scored"),
        _report_median("error", "''", "tail", "error", "tail"),
        _report_median("error_by_horizon", "CAST(horizon AS VARCHAR)", "all", "(prediction - target)", "scored"),
    ]
    + [_report_median("feature", f"'{f}'", p, f, p) for p, names in (("severe", dict.fromkeys([*HISTORY, *NUMERIC])), ("tail", HISTORY), ("well", NUMERIC)) for f in names]
)


def _cells(source: str, origin: str) -> str:
    return f"SELECT {origin} AS origin, horizon, {metrics()} FROM {source} GROUP BY 1, 2"


MODELS = f"""
cells AS (
  SELECT 'persistence' AS model, * FROM ({_cells("naive", "date")})
  UNION ALL SELECT 'weekly_seasonal', * FROM ({_cells("seasonal", "origin")})
  UNION ALL SELECT 'stand_in', * FROM ({_cells("stand_in", "date")})),
averages AS (SELECT model, AVG(wape) AS average_wape, COUNT(*) AS cells FROM cells GROUP BY model)"""

SLICE_METRICS = metrics()


def _with(ctes: list[str], query: str) -> str:
    return f"WITH {', '.join(ctes)}\n{query}"


def _statements() -> dict[str, str]:
    d = DIAGNOSTICS
    q: dict[str, str] = {}
    # profiling
    q["table_shapes"] = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS rows, {width} AS columns FROM {name}"
        for name, width in TABLES.items()
    )
    order_columns = [
        ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
        ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
    ]
    q["schema_profile"] = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT({c}) AS non_null FROM orders" for c, t in order_columns
    )
    joined = ("store_nbr", "family", "date", "sales", "onpromotion", "city", "state", "store_type", "store_cluster")
    q["null_audit"] = _with(
        FLAGGED,
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS nulls FROM flags" for c in joined
        ),
    )
    q["total_nulls"] = _with(
        FEATURED,
        "SELECT " + " + ".join(f"COUNT(*) - COUNT({c})" for c in ("lag_7", "lag_14", "lag_28", "lag_365"))
        + " AS total_nulls FROM f",
    )
    q["duplicate_rows"] = (
        "SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * "
        "FROM lineitem)) AS duplicate_rows FROM lineitem"
    )
    q["sales_summary"] = _with(
        BASE,
        """SELECT COUNT(sales) AS count, AVG(sales) AS mean, STDDEV_SAMP(sales) AS std, MIN(sales) AS min,
  QUANTILE_CONT(sales, 0.25) AS q25, QUANTILE_CONT(sales, 0.5) AS q50, QUANTILE_CONT(sales, 0.75) AS q75,
  MAX(sales) AS max FROM panel""",
    )
    q["price_summary"] = """SELECT COUNT(l_extendedprice) AS count, AVG(l_extendedprice) AS mean,
  STDDEV_SAMP(l_extendedprice) AS std, MIN(l_extendedprice) AS min, QUANTILE_CONT(l_extendedprice, 0.25) AS q25,
  QUANTILE_CONT(l_extendedprice, 0.5) AS q50, QUANTILE_CONT(l_extendedprice, 0.75) AS q75,
  MAX(l_extendedprice) AS max FROM lineitem"""
    q["zero_negative_share"] = _with(
        BASE,
        """SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE sales = 0) AS zeros,
  COUNT(*) FILTER (WHERE sales = 0) * 100.0 / COUNT(*) AS zero_pct,
  COUNT(*) FILTER (WHERE sales < 0) AS negatives FROM panel""",
    )
    q["sales_median_max"] = _with(BASE, "SELECT MAX(sales) AS max, MEDIAN(sales) AS median FROM panel")
    q["sales_histogram"] = _with(
        [*BASE, "ends AS (SELECT MIN(sales) AS low, MAX(sales) AS high FROM panel)"],
        """SELECT b.bin, COUNT(p.sales) AS count FROM range(100) b(bin)
LEFT JOIN (SELECT sales, LEAST(CAST(FLOOR((sales - low) / ((high - low) / 100)) AS BIGINT), 99) AS bin
           FROM panel CROSS JOIN ends) p ON p.bin = b.bin GROUP BY 1""",
    )
    q["sales_boxplot"] = _with(
        [
            *BASE,
            """q AS (SELECT QUANTILE_CONT(sales, 0.25) AS q1, MEDIAN(sales) AS median,
                     QUANTILE_CONT(sales, 0.75) AS q3 FROM panel),
fence AS (SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM q)""",
        ],
        """SELECT ANY_VALUE(q1) AS q1, ANY_VALUE(median) AS median, ANY_VALUE(q3) AS q3,
  MIN(sales) FILTER (WHERE sales BETWEEN low AND high) AS whisker_low,
  MAX(sales) FILTER (WHERE sales BETWEEN low AND high) AS whisker_high,
  COUNT(*) FILTER (WHERE NOT sales BETWEEN low AND high) AS outliers FROM panel CROSS JOIN fence""",
    )
    # exploration
    q["panel"] = _with(BASE, "SELECT * FROM panel")
    q["parsed_dates"] = """SELECT YEAR(o_orderdate) AS year, 'date' AS data_type, COUNT(*) AS rows,
  MIN(CAST(o_orderdate AS DATE)) AS first_day, MAX(CAST(o_orderdate AS DATE)) AS last_day FROM orders GROUP BY 1"""
    q["narrowed_panel"] = _with(
        BASE,
        """SELECT family, COUNT(TRY_CAST(store_nbr AS SMALLINT)) AS stores, SUM(TRY_CAST(onpromotion AS SMALLINT)) AS onpromotion,
  'smallint' AS store_type, 'smallint' AS onpromotion_type FROM panel GROUP BY 1""",
    )
    q["numeric_readings"] = """SELECT o_orderpriority, COUNT(TRY_CAST(o_orderpriority AS DOUBLE)) AS whole,
  SUM(TRY_CAST(SUBSTR(o_orderpriority, 1, 1) AS DOUBLE)) AS ranks, SUM(o_totalprice) AS price FROM orders GROUP BY 1"""
    q["quarantined_orders"] = """SELECT CONCAT_WS(', ', CASE WHEN o_orderkey % 89 = 0 THEN 'o_orderdate' END,
  CASE WHEN o_orderkey % 97 = 0 THEN 'o_totalprice' END) AS reason, COUNT(*) AS rows FROM orders GROUP BY 1"""
    q["panel_total"] = "SELECT SUM(l_quantity) AS sales FROM lineitem"
    q["daily_total"] = _with([*BASE, DAILY], "SELECT * FROM daily")
    q["daily_span"] = _with(
        [*BASE, DAILY], "SELECT MIN(date) AS first_day, MAX(date) AS last_day, COUNT(*) AS days FROM daily"
    )
    q["year_profile"] = _with(
        [*BASE, DAILY], "SELECT YEAR(date) AS year, DAYOFYEAR(date) AS day_of_year, sales FROM daily"
    )
    q["year_columns"] = _with(
        [*BASE, DAILY],
        """SELECT d.day_of_year, y.year, MAX(s.sales) AS sales
FROM (SELECT DISTINCT DAYOFYEAR(date) AS day_of_year FROM daily) d CROSS JOIN (SELECT DISTINCT YEAR(date) AS year FROM daily) y
LEFT JOIN daily s ON DAYOFYEAR(s.date) = d.day_of_year AND YEAR(s.date) = y.year GROUP BY 1, 2""",
    )
    q["monthly_seasonality"] = _with(
        [*BASE, DAILY], "SELECT MONTH(date) AS month, AVG(sales) AS mean_sales FROM daily GROUP BY 1"
    )
    q["weekly_seasonality"] = _with(
        [*BASE, DAILY], "SELECT ISODOW(date) - 1 AS weekday, AVG(sales) AS mean_sales FROM daily GROUP BY 1"
    )
    q["transactions_by_day"] = """SELECT CAST(o_orderdate AS DATE) AS date, c_nationkey AS store_nbr,
  COUNT(*) AS transactions FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2"""
    # enrichment
    q["store_enriched"] = _with(
        FLAGGED, "SELECT store_nbr, family, date, sales, city, state, store_type, store_cluster FROM flags"
    )
    q["holiday_flags"] = _with(
        FLAGGED, "SELECT store_nbr, family, date, is_holiday FROM flags"
    )
    q["event_flags"] = _with(
        FLAGGED, "SELECT store_nbr, family, date, is_black_friday, is_cyber_monday, is_mothers_day FROM flags"
    )
    q["calendar_columns"] = _with(
        BASE,
        """SELECT ISODOW(date) - 1 AS day_of_week, MONTH(date) AS month, COUNT(*) AS rows, SUM(sales) AS sales
FROM panel GROUP BY 1, 2""",
    )
    q["flag_audit"] = _with(
        FLAGGED,
        " UNION ALL ".join(
            f"SELECT '{c}' AS flag, 'int' AS data_type, SUM({c}) AS flag_sum, MIN({c}) AS lowest, "
            f"MAX({c}) AS highest, 0 AS not_binary FROM flags"
            for c in FLAGS
        ),
    )
    # features
    keyed = "SELECT store_nbr, family, date, {} FROM f"
    q["lag_features"] = _with(FEATURED, keyed.format("lag_7, lag_14, lag_28, lag_365"))
    q["rolling_means"] = _with(FEATURED, keyed.format("rolling_mean_7, rolling_mean_14, rolling_mean_28"))
    q["rolling_stds"] = _with(FEATURED, keyed.format("rolling_std_7, rolling_std_14, rolling_std_28, rolling_cv_28"))
    q["trend_features"] = _with(FEATURED, keyed.format("momentum_7_28, momentum_14_28, trend_7_28, yearly_ratio"))
    q["trend_features_ratio"] = _with(
        FEATURED,
        keyed.format(
            "rolling_mean_7 / NULLIF(rolling_mean_28, 0) AS momentum_7_28, "
            "rolling_mean_14 / NULLIF(rolling_mean_28, 0) AS momentum_14_28, "
            "rolling_mean_7 - rolling_mean_28 AS trend_7_28, sales / NULLIF(lag_365, 0) AS yearly_ratio"
        ),
    )
    q["spike_features"] = _with(FEATURED, keyed.format("is_spike_day, historical_spike_rate"))
    # direct dataset
    for h in (1, 7, 15):
        q[f"direct_h{h}"] = _with(
            [PANEL, FEATURES, STORES, direct_cte("TRUE", f"{h}, {h + 1}")], "SELECT * FROM d"
        )
    q["direct_all_summary"] = _with(
        EVERY,
        """SELECT horizon, COUNT(*) AS rows, SUM(target) AS target, SUM(origin_sales) AS origin_sales,
  COUNT(lag_7) AS lag_7_rows, COUNT(lag_14) AS lag_14_rows, SUM(lag_28) AS lag_28, SUM(lag_365) AS lag_365,
  SUM(day_of_week) AS day_of_week, SUM(month) AS month, MIN(target_date) AS first_target,
  MAX(target_date) AS last_target FROM d GROUP BY horizon""",
    )
    q["train_slice_counts"] = _with(
        EVERY,
        f"""SELECT horizon, COUNT(*) AS rows, SUM(target) AS target, MIN(date) AS first_origin, MAX(date) AS last_origin
FROM d WHERE date BETWEEN DATE '{SPLIT.train_start}' AND DATE '{SPLIT.train_end}' GROUP BY horizon""",
    )
    q["train_purged_counts"] = _with(
        EVERY,
        f"""SELECT horizon, COUNT(*) AS rows, SUM(target) AS target, MIN(date) AS first_origin, MAX(date) AS last_origin
FROM d WHERE date BETWEEN DATE '{SPLIT.train_start}' AND DATE '{SPLIT.train_end}'
  AND target_date <= DATE '{SPLIT.train_end}' GROUP BY horizon""",
    )
    q["valid_slice"] = _with(VALID, "SELECT * FROM d")
    # model
    training = f"d WHERE date BETWEEN DATE '{SPLIT.train_start}' AND DATE '{SPLIT.train_end}'"
    q["category_domains"] = _with(
        EVERY, " UNION ALL ".join(f"SELECT '{c}' AS feature, COUNT(DISTINCT {c}) AS levels FROM {training}" for c in CATEGORICAL)
    )
    q["target_encoding"] = _with(
        EVERY,
        f"""SELECT store_nbr, (SUM(target) + 20.0 * (SELECT AVG(target) FROM {training})) / (COUNT(*) + 20) AS store_nbr_mean
FROM {training} GROUP BY 1""",
    )
    q["model_checks"] = _with(
        VALID,
        f"""SELECT 'attribution' AS check_name, LEAST(COUNT(*), {d.sample_size}) AS checked, 0 AS violations, NULL AS target FROM d
UNION ALL SELECT 'scored', COUNT(*), 0, SUM(target) FROM d
UNION ALL SELECT 'importance', {len(model_features())}, 0, NULL""",
    )
    q["gbt_completeness"] = _with(
        VALID, "SELECT COUNT(*) AS scored_rows, 0 AS missing, COUNT(*) AS input_rows, 1 AS complete FROM d"
    )
    q["tail_slices"] = _with(
        EVERY,
        f"""SELECT COUNT(*) FILTER (WHERE date BETWEEN DATE '{SPLIT.train_start}' AND DATE '{SPLIT.train_end}')
    AS tail_train_rows, COUNT(*) FILTER (WHERE date IN ({BASE_ORIGINS})) AS tail_valid_rows
FROM d WHERE target > {d.tail_threshold}""",
    )
    train = f"date BETWEEN DATE '{SPLIT.train_start}' AND DATE '{SPLIT.train_end}'"
    q["set_sizes"] = _with(
        EVERY,
        f"""SELECT 'direct' AS set_name, COUNT(*) AS rows, {len(model_features())} AS columns FROM d
UNION ALL SELECT 'train', COUNT(*), {len(model_features())} FROM d WHERE {train}
UNION ALL SELECT 'validation', COUNT(*), {len(model_features())} FROM d WHERE date IN ({ORIGINS})
UNION ALL SELECT 'tail', COUNT(*), {len(model_features())} FROM d WHERE date IN ({ORIGINS}) AND target > {d.tail_threshold}""",
    )
    q["overlap_audit"] = _with(
        EVERY,
        f"""SELECT COUNT(*) FILTER (WHERE {train}) AS train_rows,
  COUNT(*) FILTER (WHERE date IN ({ORIGINS})) AS validation_rows,
  COUNT(*) FILTER (WHERE {train} AND date IN ({ORIGINS})) AS shared_rows,
  COUNT(*) FILTER (WHERE {train} AND target_date > DATE '{SPLIT.train_end}') AS train_targets_after_split FROM d""",
    )
    # baselines
    q["naive_forecast"] = _with(NAIVES, "SELECT store_nbr, family, date, horizon, target, prediction FROM naive")
    q["naive_scores"] = _with(NAIVES, _cells("naive", "date"))
    q["seasonal_forecast"] = _with([*BASE, SEASONAL], "SELECT * FROM seasonal")
    q["seasonal_scores"] = _with([*BASE, SEASONAL], _cells("seasonal", "origin"))
    # the panel has every day, so the last day of a weekday up to an origin is at most six days before it
    year = f"""
year AS (SELECT CAST(UNNEST(GENERATE_SERIES(DATE '{SPLIT.train_start}', DATE '{SPLIT.train_end}', INTERVAL 1 DAY)) AS DATE) AS origin),
every AS (
  SELECT p.sales AS target, r.sales AS prediction
  FROM panel p JOIN year o ON p.date > o.origin AND p.date <= o.origin + 15
  LEFT JOIN panel r ON r.store_nbr = p.store_nbr AND r.family = p.family
       AND r.date = o.origin - CAST((ISODOW(o.origin) - ISODOW(p.date) + 7) % 7 AS INTEGER))"""
    q["seasonal_year_scores"] = _with([*BASE, year], f"SELECT {metrics()} FROM every")
    stand_in = "stand_in AS (SELECT *, GREATEST(rolling_mean_28, lag_28) AS prediction FROM d)"
    q["model_comparison"] = _with(
        [*NAIVES, SEASONAL, stand_in, MODELS],
        """SELECT model, average_wape, cells, (1 - (SELECT average_wape FROM averages WHERE model = 'weekly_seasonal')
  / NULLIF(average_wape, 0)) * 100 AS reduction_pct FROM averages""",
    )
    q["model_comparison_common"] = _with(
        [
            *NAIVES,
            SEASONAL,
            stand_in,
            """shared AS (SELECT store_nbr, family, date AS origin, horizon FROM naive
                       INTERSECT SELECT store_nbr, family, origin, horizon FROM seasonal)""",
            f"""cells AS (SELECT 'persistence' AS model, * FROM ({_cells(
                "(SELECT n.* FROM naive n JOIN shared s ON n.store_nbr = s.store_nbr AND n.family = s.family "
                "AND n.date = s.origin AND n.horizon = s.horizon)", "date")})
            UNION ALL SELECT 'weekly_seasonal', * FROM ({_cells(
                "(SELECT w.* FROM seasonal w JOIN shared s ON w.store_nbr = s.store_nbr AND w.family = s.family "
                "AND w.origin = s.origin AND w.horizon = s.horizon)", "origin")}))""",
        ],
        "SELECT model, AVG(wape) AS average_wape, COUNT(*) AS cells FROM cells GROUP BY model",
    )
    # confidence
    q["confidence_thresholds"] = _with(LABELLED, "SELECT * FROM limits")
    q["confidence_labels"] = _with(
        LABELLED, "SELECT store_nbr, family, date, horizon, prediction_confidence, abs_error FROM labelled"
    )
    q["confidence_validation"] = _with(
        LABELLED,
        f"""SELECT prediction_confidence AS confidence_tier,
  CASE prediction_confidence WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END AS tier_order, {metrics("100")},
  COUNT(*) FILTER (WHERE prediction < 0.5 * target AND target > {d.tail_threshold}) * 100.0
    / GREATEST(COUNT(*) FILTER (WHERE target > {d.tail_threshold}), 1) AS severe_rate_pct,
  100.0 * COALESCE(SUM(target) FILTER (WHERE target > {d.tail_threshold}), 0)
    / NULLIF(SUM(SUM(target) FILTER (WHERE target > {d.tail_threshold})) OVER (), 0) AS tail_volume_pct
FROM labelled WHERE prediction_confidence <> 'unknown' GROUP BY 1, 2""",
    )
    # tail
    q["tail_rows"] = _with(
        TAILS,
        "SELECT store_nbr, family, date, horizon, target, prediction, error, absolute_error, prediction_ratio FROM tail",
    )
    q["tail_overall"] = _with(
        TAILS, f"SELECT {metrics('100')}, AVG(error) AS mean_error, MEDIAN(error) AS median_error FROM tail"
    )
    q["tail_by_horizon"] = _with(TAILS, f"SELECT horizon, {TAIL_METRICS} FROM tail GROUP BY 1")
    q["tail_by_origin"] = _with(TAILS, f"SELECT date AS origin, {TAIL_METRICS} FROM tail GROUP BY 1")
    q["tail_spike_severity"] = _with(
        TAILS, f"SELECT {SPIKE[0]} AS spike_level, {SPIKE[1]} AS level_order, {TAIL_METRICS} FROM tail GROUP BY 1, 2"
    )
    q["tail_largest_under"] = _with(TAILS, TAIL_LIST.format(source="tail", column="error", n=d.tail_list))
    labels = " UNION ALL ".join(
        f"SELECT {i} AS level_order, '{name}' AS prediction_coverage" for i, name in enumerate(d.coverage_labels)
    )
    q["tail_coverage"] = _with(
        TAILS,
        f"""SELECT l.level_order, l.prediction_coverage, COUNT(t.bin) AS count,
  COUNT(t.bin) * 100.0 / (SELECT COUNT(*) FROM tail) AS percentage
FROM ({labels}) l LEFT JOIN (SELECT {COVERAGE[1]} AS bin FROM tail) t ON t.bin = l.level_order GROUP BY 1, 2""",
    )
    q["tail_under_rates"] = _with(
        TAILS,
        """SELECT AVG(CASE WHEN prediction < target THEN 1.0 ELSE 0 END) * 100 AS underprediction_rate_pct,
  AVG(CASE WHEN prediction_ratio < 0.5 THEN 1.0 ELSE 0 END) * 100 AS severe_underprediction_rate_pct FROM tail""",
    )
    # severe
    q["severe_overview"] = _with(
        TAILS,
        """SELECT COUNT(*) AS tail_rows, COUNT(*) FILTER (WHERE prediction_ratio < 0.5) AS severe_rows,
  COUNT(*) FILTER (WHERE prediction_ratio < 0.5) * 100.0 / NULLIF(COUNT(*), 0) AS severe_rate FROM tail""",
    )
    q["severe_by_family"] = _with(TAILS, severe_by("family"))
    q["severe_by_store"] = _with(
        TAILS, severe_by("store_nbr") + f" ORDER BY severe_count DESC, store_nbr LIMIT {d.store_list}"
    )
    q["severe_by_horizon"] = _with(TAILS, severe_by("horizon"))
    q["severe_by_origin"] = _with(TAILS, severe_by("date", "origin"))
    q["severe_history_compare"] = _with(TAILS, HISTORY_COMPARE)
    q["severe_worst"] = _with(TAILS, TAIL_LIST.format(source="severe", column="prediction_ratio", n=d.severe_list))
    q["well_predicted"] = _with(
        TAILS, "SELECT store_nbr, family, date, horizon, target, prediction, prediction_ratio FROM well"
    )
    q["series_concentration"] = _with(
        TAILS,
        severe_by("CAST(store_nbr AS VARCHAR) || ' | ' || family", "series")
        + f" ORDER BY severe_count DESC, severe_rate DESC, series LIMIT {d.series_list}",
    )
    q["severe_summary"] = _with(
        TAILS,
        f"""SELECT (SELECT COUNT(*) FROM severe) AS severe_rows,
  (SELECT COUNT(*) FROM severe) * 100.0 / COUNT(*) AS severe_rate,
  (SELECT COUNT(*) FROM well) AS well_predicted_rows,
  (SELECT COUNT(DISTINCT (store_nbr, family)) FROM severe) AS severe_series,
  {len(HISTORY)} AS history_features FROM tail""",
    )
    q["promotion_test"] = _with(
        TAILS,
        """SELECT (SELECT COUNT(*) FROM severe) AS severe_rows, (SELECT COUNT(*) FROM well) AS well_rows,
  (SELECT AVG(CASE WHEN target_onpromotion > 0 THEN 100.0 ELSE 0 END) FROM severe) AS severe_promotion_pct,
  (SELECT AVG(CASE WHEN target_onpromotion > 0 THEN 100.0 ELSE 0 END) FROM well) AS well_promotion_pct""",
    )
    # signal
    q["signal_population"] = _with(
        TAILS, "SELECT (SELECT COUNT(*) FROM severe) AS severe_rows, (SELECT COUNT(*) FROM well) AS well_rows"
    )
    q["signal_numeric"] = _with(TAILS, NUMERIC_SIGNAL)
    q["signal_strongest"] = _with(
        TAILS,
        f"""SELECT feature, relative_mean_difference_pct FROM ({NUMERIC_SIGNAL})
ORDER BY ABS(relative_mean_difference_pct) DESC NULLS LAST, feature LIMIT 1""",
    )
    q["signal_categorical"] = _with([*TAILS, TRAIN_LEVELS], CATEGORICAL_SIGNAL)
    # errors
    q["error_by_horizon"] = _with(
        ERRS, f"SELECT horizon, {metrics('100')}, AVG(error) AS mean_error FROM errors GROUP BY 1"
    )
    q["error_by_origin"] = _with(
        ERRS, f"SELECT date AS origin, {metrics('100')}, AVG(error) AS mean_error FROM errors GROUP BY 1"
    )
    q["error_by_sales_level"] = _with(
        ERRS,
        f"""SELECT {LEVEL[0]} AS sales_level, {LEVEL[1]} AS level_order, {metrics("100")}, AVG(error) AS mean_error
FROM errors GROUP BY 1, 2""",
    )
    q["bias_overall"] = _with(
        ERRS,
        """SELECT AVG(error) AS mean_error, CASE WHEN AVG(error) < 0 THEN 'under' WHEN AVG(error) > 0 THEN 'over'
  ELSE 'none' END AS direction, MEDIAN(error) AS median_error FROM errors""",
    )
    q["bias_by_horizon"] = _with(
        ERRS, "SELECT horizon, AVG(error) AS mean_error, MEDIAN(error) AS median_error FROM errors GROUP BY 1"
    )
    q["worst_predictions"] = _with(
        ERRS,
        f"SELECT * FROM errors ORDER BY absolute_error DESC, store_nbr, family, date, horizon LIMIT {d.worst_list}",
    )
    q["error_summary"] = _with(ERRS, f"SELECT {metrics('100')}, AVG(error) AS mean_error FROM errors")
    # evaluation
    q["eval_origin_horizon"] = _with(SCORES, _cells("scored", "date"))
    q["eval_overall"] = _with(SCORES, f"SELECT {metrics()} FROM scored")
    q["eval_horizon_average"] = _with(
        SCORES,
        f"""SELECT horizon, AVG(mae) AS mae, AVG(rmse) AS rmse, AVG(wape) * 100 AS wape_pct
FROM ({_cells("scored", "date")}) GROUP BY 1""",
    )
    q["eval_slices"] = _with(
        SCORES,
        f"""SELECT 'horizon' AS slice, CAST(horizon AS VARCHAR) AS level, {SLICE_METRICS} FROM scored GROUP BY horizon
UNION ALL SELECT 'date', CAST(date AS VARCHAR), {SLICE_METRICS} FROM scored GROUP BY date
UNION ALL SELECT 'family', family, {SLICE_METRICS} FROM scored GROUP BY family
UNION ALL SELECT 'all', 'all', {SLICE_METRICS} FROM scored""",
    )
    q["report_slices"] = _with(
        [*LABELLED, ALL_ROWS],
        " UNION ALL ".join(
            _report_slice("tail_rows" if name.startswith("tail") else "all_rows", name, keys) for name, keys in REPORT_SLICES.items()
        ),
    )
    q["future_forecast"] = _with(
        [PANEL, FEATURES, STORES, direct_cte("f.date = (SELECT MAX(date) FROM panel)", future=True), SCORED],
        "SELECT store_nbr, family, date AS origin, horizon, target_date, prediction FROM scored",
    )
    q["report_quantiles"] = _with(TAILS, REPORT_QUANTILES)
    q["sample_fixed"] = _with(
        SCORES,
        f"""SELECT store_nbr, family, date, horizon, target, prediction FROM scored
ORDER BY MD5(CONCAT_WS('|', store_nbr, family, CAST(date AS VARCHAR), horizon, '{d.seed}')), store_nbr, family, date, horizon
LIMIT {d.sample_size}""",
    )
    return q


def oracle_sql() -> dict[str, str]:
    """One statement per registered query, with the same column names and roundings."""
    return {name: sql_select(OUTPUTS[name], text) for name, text in _statements().items()}
