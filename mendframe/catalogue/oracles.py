"""The same results as SQL over the driver tables, to check the queries in a second engine."""

from __future__ import annotations

from itertools import combinations

from mendframe import fixed_values as fixed

PROPERTY_COLUMNS = [
    "id_predio", "estrato", "barrio_nombre", "avaluo_total", "area_construida", "puntaje", "tipo_construccion",
]
NUMBERS = ["estrato", "avaluo_total", "area_construida", "puntaje"]
TEXTS = ["id_predio", "barrio_nombre", "tipo_construccion"]
FLAGS = ["area_construida_imputada", "puntaje_imputado", "tipo_construccion_imputado"]

PROPERTIES = """
base AS (
 SELECT
  CASE WHEN l_orderkey % 211 = 0 THEN NULL ELSE CAST(l_orderkey AS VARCHAR) END AS id_predio,
  p_size % 7 AS estrato,
  CASE WHEN l_suppkey % 5 = 0 THEN CONCAT(' ', UPPER(p_brand), '  ') ELSE p_brand END AS barrio_nombre,
  CASE WHEN l_suppkey % 53 = 0 THEN 0.0E0 ELSE l_extendedprice END AS avaluo_total,
  CASE WHEN l_partkey % 24 = 0 THEN NULL WHEN l_partkey % 97 = 0 THEN 0.0E0
       WHEN l_partkey % 101 = 0 THEN -1.0E0 ELSE l_quantity * 3 END AS area_construida,
  CASE WHEN l_partkey % 24 = 0 THEN NULL WHEN l_linenumber = 7 AND l_suppkey % 10 = 0 THEN 101.0E0
       ELSE CAST(ROUND(l_discount * 100) AS DOUBLE) * 10 END AS puntaje,
  CASE WHEN l_partkey % 24 = 0 THEN NULL WHEN l_quantity > 48 THEN ' '
       WHEN l_linestatus = 'F' AND l_quantity < 3 THEN LOWER(l_returnflag) ELSE l_returnflag END AS tipo_construccion,
  l_partkey AS src_part
 FROM lineitem JOIN part ON l_partkey = p_partkey
), properties AS (
 SELECT id_predio, estrato, barrio_nombre, avaluo_total, area_construida, puntaje, tipo_construccion FROM base
 UNION ALL
 SELECT id_predio, estrato, barrio_nombre, avaluo_total, area_construida, puntaje, tipo_construccion FROM base
 WHERE src_part % 50 = 0
)"""

TYPED = """
typed AS (
 SELECT id_predio, CAST(estrato AS VARCHAR) AS estrato, barrio_nombre, avaluo_total, area_construida, puntaje,
  tipo_construccion FROM properties
)"""

KEEP_ORDER = (
    "avaluo_total DESC NULLS LAST, area_construida ASC NULLS LAST, puntaje ASC NULLS LAST, "
    "tipo_construccion ASC NULLS LAST, barrio_nombre ASC NULLS LAST, estrato ASC NULLS LAST"
)

CLEANED = f"""
ranked AS (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY id_predio ORDER BY {KEEP_ORDER}) AS rn
 FROM (SELECT DISTINCT * FROM typed) d WHERE id_predio IS NOT NULL
), repaired AS (
 SELECT id_predio, estrato, barrio_nombre, avaluo_total,
  CASE WHEN area_construida >= 0 THEN area_construida END AS area_construida,
  CASE WHEN puntaje BETWEEN 0 AND 100 THEN puntaje END AS puntaje, tipo_construccion
 FROM ranked WHERE rn = 1 AND NOT COALESCE(avaluo_total <= 0, FALSE)
), cleaned AS (
 SELECT id_predio, TRIM(estrato) AS estrato, LOWER(TRIM(barrio_nombre)) AS barrio_nombre, avaluo_total,
  area_construida, puntaje, LOWER(TRIM(tipo_construccion)) AS tipo_construccion,
  CASE WHEN TRIM(estrato) = '0' THEN 1 ELSE 0 END AS es_comercial,
  CASE WHEN area_construida > 0 THEN avaluo_total / area_construida END AS avaluo_por_m2,
  0 AS area_construida_imputada, 0 AS puntaje_imputado, 0 AS tipo_construccion_imputado
 FROM repaired
)"""
CLEAN_COLUMNS = [*PROPERTY_COLUMNS, "es_comercial", "avaluo_por_m2", *FLAGS]

FILLED = """
means AS (SELECT barrio_nombre AS g, AVG(area_construida) AS m FROM cleaned GROUP BY 1),
filled AS (
 SELECT id_predio, estrato, c.barrio_nombre, avaluo_total,
  COALESCE(area_construida, m, (SELECT AVG(area_construida) FROM cleaned)) AS area_construida, puntaje,
  tipo_construccion, es_comercial, avaluo_por_m2, puntaje_imputado, tipo_construccion_imputado,
  CASE WHEN area_construida IS NULL THEN 1 ELSE 0 END AS area_construida_imputada
 FROM cleaned c LEFT JOIN means ON c.barrio_nombre IS NOT DISTINCT FROM g
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


RAW = with_(PROPERTIES)
RAW_TYPED = with_(PROPERTIES, TYPED)
CLEAN = with_(PROPERTIES, TYPED, CLEANED)
BASELINE = with_(PROPERTIES, TYPED, CLEANED, FILLED)


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


def big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def r(expression: str, digits: int = 6) -> str:
    return f"ROUND({expression}, {digits})"


def nulls_of(columns, source) -> str:
    return " + ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL)" for c in columns)


def health(columns: list[str], source: str) -> str:
    """One row: rows, null cells, extras and members of duplicate groups."""
    listed = ", ".join(columns)
    null_cells = " + ".join(f"(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in columns)
    return f"""SELECT {big('SUM(n)')} AS n_rows, {big(f'SUM(n * ({null_cells}))')} AS null_cells,
 {big('SUM(n - 1)')} AS extras, {big('COALESCE(SUM(n) FILTER (WHERE n > 1), 0)')} AS members
 FROM (SELECT {listed}, COUNT(*) AS n FROM {source} GROUP BY {listed}) g"""


def score(columns: list[str], source: str, duplicates: str) -> str:
    return f"""SELECT completeness, consistency, 0.6 * completeness + 0.4 * consistency AS score,
 CASE WHEN 0.6 * completeness + 0.4 * consistency >= 90 THEN 'EXCELENTE'
  WHEN 0.6 * completeness + 0.4 * consistency >= 75 THEN 'BUENA'
  WHEN 0.6 * completeness + 0.4 * consistency >= 60 THEN 'ACEPTABLE' ELSE 'CRÍTICA' END AS state
 FROM (SELECT 100 - 100.0E0 * null_cells / (n_rows * {len(columns)}) AS completeness,
  100 - 100.0E0 * {duplicates} / n_rows AS consistency FROM ({health(columns, source)}) h) s"""


def null_rows() -> str:
    return union(
        f"SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls,"
        f" {r(f'100.0E0 * COUNT(*) FILTER (WHERE {c} IS NULL) / COUNT(*)')} AS null_percent,"
        f" {r(f'100 - 100.0E0 * COUNT(*) FILTER (WHERE {c} IS NULL) / COUNT(*)')} AS reliability FROM properties"
        for c in PROPERTY_COLUMNS
    )


def numeric_row(c: str, source: str) -> str:
    return f"""SELECT '{c}' AS "column", n AS count, {r('mean')} AS mean, {r('median')} AS median, {r('std')} AS std,
 {r('low')} AS min, {r('high')} AS max, {r('q1')} AS q25, {r('q3')} AS q75,
 zeros, {r('100.0E0 * zeros / n')} AS zeros_percent, negatives, {r('100.0E0 * negatives / n')} AS negatives_percent,
 outliers, {r('100.0E0 * outliers / n')} AS outliers_percent,
 {r('100 - 100.0E0 * (zeros + negatives + outliers) / n')} AS reliability
FROM (SELECT n, mean, median, std, low, high, q1, q3, zeros, negatives,
  (SELECT COUNT(*) FROM {source} WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outliers
 FROM (SELECT COUNT({c}) AS n, AVG({c}) AS mean, QUANTILE_CONT({c}, 0.5) AS median, STDDEV_SAMP({c}) AS std,
  CAST(MIN({c}) AS DOUBLE) AS low, CAST(MAX({c}) AS DOUBLE) AS high, QUANTILE_CONT({c}, 0.25) AS q1,
  QUANTILE_CONT({c}, 0.75) AS q3, COUNT(*) FILTER (WHERE {c} = 0) AS zeros,
  COUNT(*) FILTER (WHERE {c} < 0) AS negatives FROM {source}) a) b"""


def value_counts(columns: list[str], source: str) -> str:
    return union(
        f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value, COUNT(*) AS n FROM {source} GROUP BY 2" for c in columns
    )


def melted(values: dict[str, str], source: str, labels: str = "metric") -> str:
    return union(f"SELECT '{k}' AS {labels}, CAST({v} AS DOUBLE) AS value FROM {source}" for k, v in values.items())


NORMAL = (
    "SQRT(-2.0E0 * LN((CAST('0x' || SUBSTRING(MD5({key} || ':{seed}a'), 1, 8) AS BIGINT) + 1) / 4294967296.0E0))"
    " * COS(2.0E0 * PI() * (CAST('0x' || SUBSTRING(MD5({key} || ':{seed}b'), 1, 8) AS BIGINT) / 4294967296.0E0))"
    " * {scale}"
)


def digest_number(key: str, seed: str) -> str:
    return f"CAST('0x' || SUBSTRING(MD5({key} || ':{seed}'), 1, 8) AS BIGINT)"


def uniform(key: str, seed: str) -> str:
    return f"({digest_number(key, seed)} / 4294967296.0E0)"


# --- enrichment sources ------------------------------------------------------------------------

FEATURES = """
features AS (
 SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN ' ' || LOWER(p_brand) || ' ' ELSE p_brand END AS nombre,
  p_type || CAST(p_partkey AS VARCHAR) AS codigo,
  CASE WHEN p_partkey % 10 <> 0 THEN p_retailprice * 100 END AS area_raw
 FROM part
), tier1 AS (
 SELECT DISTINCT UPPER(p_brand) AS name, n % 6 + 1 AS stratum, 300 + 100 * n AS base_count, n * 30000000 AS base_value
 FROM (SELECT p_brand, CAST(SPLIT_PART(p_brand, '#', 2) AS BIGINT) AS n FROM part) b WHERE n <= 12
), tier2 AS (
 SELECT DISTINCT SUBSTRING(p_type, 1, 2) AS code, LENGTH(p_type) - 3 AS stratum, 800 AS base_count,
  LENGTH(p_type) * 20000000 AS base_value
 FROM part WHERE SUBSTRING(p_type, 1, 2) IN ('EC', 'PR', 'LA')
), found AS (
 SELECT id, nombre, area_raw,
  CASE WHEN name IS NOT NULL THEN tier1.stratum WHEN code IS NOT NULL THEN tier2.stratum ELSE 2 END AS stratum,
  CAST(CASE WHEN name IS NOT NULL THEN tier1.base_count WHEN code IS NOT NULL THEN tier2.base_count ELSE 500 END
   AS BIGINT) AS base_count,
  CAST(CASE WHEN name IS NOT NULL THEN tier1.base_value WHEN code IS NOT NULL THEN tier2.base_value ELSE 150000000 END
   AS BIGINT) AS base_value,
  CASE WHEN name IS NOT NULL THEN 1 WHEN code IS NOT NULL THEN 2 ELSE 0 END AS tier
 FROM features LEFT JOIN tier1 ON UPPER(TRIM(nombre)) = name LEFT JOIN tier2 ON SUBSTRING(codigo, 1, 2) = code
), counted AS (
 SELECT *, COALESCE(area_raw, 10000.0E0) AS area,
  GREATEST(50, CAST(TRUNC(base_count * (COALESCE(area_raw, 10000.0E0) / 100000.0E0)) AS BIGINT)) AS row_count
 FROM found
), enriched AS (
 SELECT id, nombre, stratum, base_count, base_value, tier, area, row_count, row_count * base_value AS total_value,
  CAST(TRUNC((row_count * base_value) / row_count) AS BIGINT) AS average_value,
  row_count / (area / 1000000.0E0) AS density,
  CASE WHEN stratum >= 5 THEN 'PREMIUM' WHEN stratum = 4 THEN 'ALTO' WHEN stratum = 3 THEN 'MEDIO ALTO'
   WHEN stratum = 2 THEN 'MEDIO' ELSE 'BAJO' END AS prestige,
  CASE WHEN stratum >= 5 THEN 5 WHEN stratum = 4 THEN 4 WHEN stratum = 3 THEN 3 WHEN stratum = 2 THEN 2 ELSE 1 END
   AS score
 FROM counted
)"""

BRANDS = """
brands AS (
 SELECT p_brand, COUNT(*) AS row_count, CAST(SUM(l_quantity) AS BIGINT) AS quantity,
  CAST(SPLIT_PART(p_brand, '#', 2) AS BIGINT) AS number
 FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
)"""

NATIONS = """
dimension AS (
 SELECT n_nationkey, '  ' || CASE WHEN n_nationkey % 4 = 3 THEN 'x' ELSE '' END || LOWER(n_name) || ' ' AS nombre FROM nation
), facts AS (
 SELECT n_name, c_custkey, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey
), totals AS (
 SELECT UPPER(TRIM(n_name)) AS name, COUNT(c_custkey) AS fact_rows, ROUND(SUM(c_acctbal), 2) AS fact_value,
  ROUND(AVG(c_acctbal), 6) AS fact_mean_area
 FROM facts GROUP BY 1
)"""

PRICED = """
priced AS (
 SELECT l_returnflag, l_extendedprice AS actual, 40000.0E0 + l_quantity * 500 AS predicted,
  CASE WHEN l_quantity > 25 THEN 'A' ELSE 'N' END AS guess
 FROM lineitem
)"""

MEASURES = {
    "r2": "1 - SUM((actual - predicted) * (actual - predicted)) / (VAR_POP(actual) * COUNT(*))",
    "mae": "AVG(ABS(actual - predicted))",
    "rmse": "SQRT(AVG((actual - predicted) * (actual - predicted)))",
    "mape": "AVG(ABS((actual - predicted) / actual)) * 100",
}

CLASSES = """
labels_ AS (SELECT l_returnflag AS label FROM priced UNION SELECT guess FROM priced),
counts AS (
 SELECT label, (SELECT COUNT(*) FROM priced WHERE l_returnflag = label) AS support,
  (SELECT COUNT(*) FROM priced WHERE guess = label) AS guessed,
  (SELECT COUNT(*) FROM priced WHERE guess = label AND l_returnflag = label) AS hits
 FROM labels_
), ratios AS (
 SELECT label, CASE WHEN guessed > 0 THEN hits / CAST(guessed AS DOUBLE) ELSE 0 END AS p,
  CASE WHEN support > 0 THEN hits / CAST(support AS DOUBLE) ELSE 0 END AS q, support, hits
 FROM counts
), scores AS (
 SELECT label, p, q, CASE WHEN p + q > 0 THEN 2 * p * q / (p + q) ELSE 0 END AS f, support, hits FROM ratios
)"""

FOLD_SCORES = """
folded AS (
 SELECT o_orderpriority, o_orderstatus, o_totalprice AS y,
  CAST('0x' || SUBSTRING(MD5(CAST(o_orderkey AS VARCHAR) || ':42'), 1, 8) AS BIGINT) % 5 AS fold
 FROM orders
), grouped AS (
 SELECT 0 AS position, 'o_orderpriority' AS candidate, o_orderpriority AS g, y, fold FROM folded
 UNION ALL
 SELECT 1 AS position, 'o_orderstatus' AS candidate, o_orderstatus AS g, y, fold FROM folded
), means AS (
 SELECT a.candidate, f.fold, a.g, AVG(a.y) FILTER (WHERE a.fold <> f.fold) AS p
 FROM grouped a, (SELECT DISTINCT fold FROM folded) f GROUP BY 1, 2, 3
), fold_scores AS (
 SELECT position, s.candidate, s.fold, 1 - SUM((y - p) * (y - p)) / (VAR_POP(y) * COUNT(*)) AS r2
 FROM grouped s JOIN means m ON s.candidate = m.candidate AND s.g = m.g AND s.fold = m.fold
 GROUP BY 1, 2, 3
), cv AS (
 SELECT position, candidate, ROUND(AVG(r2), 6) AS cv_mean, ROUND(STDDEV_POP(r2), 6) AS cv_std, AVG(r2) AS exact
 FROM fold_scores GROUP BY 1, 2
)"""


def split_sql(source: str, key: str, label: str | None, test_rows: str) -> str:
    strata = f"PARTITION BY {label}" if label else ""
    kept = f"{key}, {label}" if label else key
    return f"""SELECT {kept}, CASE WHEN rn <= {test_rows} THEN 1 ELSE 0 END AS is_test FROM (
 SELECT *, ROW_NUMBER() OVER ({strata} ORDER BY MD5(CAST({key} AS VARCHAR) || ':42'), {key}) AS rn,
  COUNT(*) OVER ({strata}) AS n FROM {source}) x"""


def category_cap_sql() -> str:
    return f"""SELECT col AS "column", value, n, rank, distinct_values > 50 AS capped FROM (
 SELECT col, value, n, ROW_NUMBER() OVER (PARTITION BY col ORDER BY n DESC, value DESC) AS rank,
  COUNT(*) OVER (PARTITION BY col) AS distinct_values
 FROM ({value_counts(['p_name', 'p_brand', 'p_type'], 'part')}) c WHERE value IS NOT NULL) x
WHERE rank <= CASE WHEN distinct_values > 50 THEN 49 ELSE 50 END"""


def dependencies_sql(source: str, columns: list[str], tolerance: float) -> str:
    """Single determinants, then pairs where neither column alone determines the dependent."""

    def violations(left: list[str], right: str) -> str:
        return f"""SELECT '{",".join(left)}' AS determinant, '{right}' AS dependent, COUNT(*) AS groups, CAST(SUM(n - top) AS BIGINT) AS violations,
 ROUND(100.0E0 * SUM(n - top) / SUM(n), 6) AS percent, CASE WHEN 100.0E0 * SUM(n - top) / SUM(n) <= {tolerance} THEN 1 ELSE 0 END AS holds
FROM (SELECT SUM(n) AS n, MAX(n) AS top FROM (SELECT {", ".join(left)}, {right}, COUNT(*) AS n FROM {source} GROUP BY ALL) c GROUP BY {", ".join(left)}) g"""

    singles = [violations([a], b) for a in columns for b in columns if a != b]
    pairs = [
        f"""SELECT p.* FROM ({violations([a, b], c)}) p
WHERE NOT EXISTS (SELECT 1 FROM singles WHERE dependent = '{c}' AND determinant IN ('{a}', '{b}') AND holds = 1)"""
        for i, a in enumerate(columns)
        for b in columns[i + 1 :]
        for c in columns
        if c not in (a, b)
    ]
    return f"WITH singles AS MATERIALIZED ({union(singles)}) SELECT * FROM singles UNION ALL {union(pairs)}"


def sample_sql() -> str:
    types = "CASE WHEN t < 0.25 THEN 'Residencial' WHEN t < 0.5 THEN 'Comercial' WHEN t < 0.75 THEN 'Mixto' ELSE 'Industrial' END"
    return f"""WITH groups AS (
 SELECT DISTINCT p_brand, 150 + {digest_number('p_brand', '42rows')} % 1350 AS n FROM part
), numbered AS (SELECT p_brand, UNNEST(RANGE(n)) AS i FROM groups),
keyed AS (SELECT 'PRED_' || REPLACE(p_brand, ' ', '') || '_' || LPAD(CAST(i AS VARCHAR), 5, '0') AS id_predio,
 p_brand AS barrio_nombre FROM numbered),
drawn AS (SELECT *, {uniform('id_predio', '42stratum')} AS s, {uniform('id_predio', '42value')} AS v,
 {uniform('id_predio', '42area')} AS a, {digest_number('id_predio', '42score')} AS p,
 {uniform('id_predio', '42type')} AS t FROM keyed)
SELECT id_predio, barrio_nombre, CASE WHEN s < 0.15 THEN 1 WHEN s < 0.35 THEN 2 WHEN s < 0.6 THEN 3 WHEN s < 0.8 THEN 4
  WHEN s < 0.95 THEN 5 ELSE 6 END AS estrato, 50000000.0E0 + v * 450000000.0E0 AS avaluo_total,
 50.0E0 + a * 450.0E0 AS area_construida, CAST(1 + p % 99 AS INTEGER) AS puntaje, {types} AS tipo_construccion
FROM drawn"""


FINGERPRINT = (
    "ARRAY_TO_STRING(LIST_SORT(LIST_DISTINCT(STRING_SPLIT(TRIM(REGEXP_REPLACE(LOWER({c}), '[^\\p{{L}}\\p{{N}}]+',"
    " ' ', 'g')), ' '))), ' ')"
)


def shipped_sql() -> str:
    """The shipped lookups as literal rows, joined to the names that the parts' keys point to."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    names = [n for n, *_ in fixed.NEIGHBOURHOODS] + ["nowhere", "elsewhere", "far away"]
    first = ", ".join(f"({quoted(n)}, {s}, {c}, {v})" for n, s, c, v in fixed.NEIGHBOURHOODS)
    second = ", ".join(
        f"({quoted(code)}, {s}, {int(fixed.DISTRICT_BASE_COUNT * cf)}, {int(fixed.DISTRICT_BASE_VALUE * vf)})"
        for code, _, s, cf, vf in fixed.DISTRICTS
    )
    static = ", ".join(f"({quoted(n.upper())}, {lat}E0, {lon}E0, {quoted(z)})" for n, lat, lon, _, _, _, z in fixed.STATIC_NEIGHBOURHOODS)
    pick = lambda c, default: f"CASE WHEN t1.name IS NOT NULL THEN t1.{c} WHEN t2.code IS NOT NULL THEN t2.{c} ELSE {default} END AS {c}"
    shown = "list_aggregate(list_transform(string_split(nombre, ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ')"
    return f"""WITH t1(name, stratum, base_count, base_value) AS (VALUES {first}), t2(code, stratum, base_count, base_value) AS (VALUES {second}),
places(name, lat, lon, zone) AS (VALUES {static}),
p AS (
 SELECT p_partkey, lower([{', '.join(map(quoted, names))}][CAST(p_partkey % {len(names)} + 1 AS INTEGER)]) AS nombre,
  lpad(CAST(p_partkey % 20 + 1 AS VARCHAR), 2, '0') AS codigo FROM part
)
SELECT p_partkey, {shown} AS shown, {pick('stratum', fixed.DEFAULT_STRATUM)}, CAST({pick('base_count', fixed.DEFAULT_COUNT).replace(' AS base_count', '')} AS BIGINT) AS base_count,
 CAST({pick('base_value', fixed.DEFAULT_VALUE).replace(' AS base_value', '')} AS BIGINT) AS base_value,
 CASE WHEN t1.name IS NOT NULL THEN 1 WHEN t2.code IS NOT NULL THEN 2 ELSE 0 END AS tier, lat, lon, zone
FROM p LEFT JOIN t1 ON upper(nombre) = t1.name LEFT JOIN t2 ON codigo = t2.code LEFT JOIN places ON upper(nombre) = places.name"""


def conformal_sql(fitted: str, last: str) -> str:
    """Out-of-fold means of orders, bins of the fitted rows' predictions and their radii, then `last`."""
    edges = ", ".join(f"QUANTILE_CONT(p, {i / 4}E0) AS e{i}" for i in (1, 2, 3))
    return f"""WITH base AS (
 SELECT o_orderkey, o_orderpriority || '|' || o_orderstatus AS g, CASE WHEN o_orderkey % 19 <> 0 THEN o_totalprice END AS y,
  CAST('0x' || SUBSTRING(MD5(CAST(o_orderkey AS VARCHAR) || ':42'), 1, 8) AS BIGINT) % 5 AS fold
 FROM orders
), cells AS (SELECT g, fold, COALESCE(SUM(y), 0) AS s, COUNT(y) AS n FROM base GROUP BY 1, 2),
totals AS (SELECT g, SUM(s) AS s, SUM(n) AS n FROM cells GROUP BY 1),
whole AS (SELECT SUM(s) AS s, SUM(n) AS n FROM cells), by_fold AS (SELECT fold, SUM(s) AS s, SUM(n) AS n FROM cells GROUP BY 1),
predicted AS MATERIALIZED (
 SELECT o_orderkey, y, fold, ROUND(CASE WHEN y IS NULL THEN COALESCE(t.s / NULLIF(t.n, 0), w.s / w.n)
  ELSE COALESCE((t.s - c.s) / NULLIF(t.n - c.n, 0), (w.s - f.s) / (w.n - f.n)) END, 6) AS p
 FROM base JOIN totals t USING (g) JOIN cells c USING (g, fold) JOIN by_fold f USING (fold), whole w
), edges AS MATERIALIZED (SELECT {edges} FROM predicted WHERE y IS NOT NULL AND {fitted}),
binned AS MATERIALIZED (
 SELECT o_orderkey, y, p, fold, ABS(y - p) AS res, CAST(p > e1 AS INTEGER) + CAST(p > e2 AS INTEGER) + CAST(p > e3 AS INTEGER) AS bin FROM predicted, edges
), ranked AS (
 SELECT bin, res, ROW_NUMBER() OVER (PARTITION BY bin ORDER BY res) AS k, COUNT(*) OVER (PARTITION BY bin) AS n
 FROM binned WHERE y IS NOT NULL AND {fitted}
), radii AS MATERIALIZED (SELECT bin, ANY_VALUE(n) AS n, MIN(res) FILTER (WHERE k = CEIL((n + 1) * 0.9E0)) AS radius FROM ranked GROUP BY 1)
{last}"""


def build() -> dict[str, str]:
    listed = ", ".join(PROPERTY_COLUMNS)
    pairs = list(combinations(PROPERTY_COLUMNS, 2))
    sql: dict[str, str] = {}

    sql["profile_basic"] = RAW + (
        "SELECT n_rows AS rows, CAST(7 AS BIGINT) AS columns, extras AS duplicate_extras, members AS duplicate_members"
        f" FROM ({health(PROPERTY_COLUMNS, 'properties')}) h"
    )
    sql["profile_nulls"] = sql["nulls_ranked"] = RAW + null_rows()
    sql["critical_columns"] = RAW + (
        f'SELECT "column", null_percent FROM ({null_rows()}) n WHERE ROUND(null_percent, 2) > 4.0'
    )
    sql["profile_numeric"] = RAW + union(numeric_row(c, "properties") for c in NUMBERS)
    sql["profile_outliers"] = 'SELECT "column", count, q25, q75, outliers, outliers_percent FROM (' + union(
        numeric_row(c, "events") for c in ("value", "user_id")
    ) + ") x"
    sql["top_values"] = RAW + (
        f"""SELECT col AS "column", rank, value, n FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY col ORDER BY n DESC, value) AS rank
 FROM ({value_counts(TEXTS, 'properties')}) v WHERE value IS NOT NULL) x WHERE rank <= 5"""
    )
    sql["profile_categorical"] = RAW + (
        f"""SELECT col AS "column", CAST(SUM(n) FILTER (WHERE value IS NOT NULL) AS BIGINT) AS count,
 COUNT(value) AS distinct_values, MAX(value) FILTER (WHERE rank = 1) AS top_value, MAX(n) FILTER (WHERE rank = 1) AS top_count,
 {r('100.0E0 * MAX(n) FILTER (WHERE rank = 1) / SUM(n) FILTER (WHERE value IS NOT NULL)')} AS top_percent,
 {r('100 - 100.0E0 * MAX(n) FILTER (WHERE rank = 1) / SUM(n) FILTER (WHERE value IS NOT NULL)')} AS diversity,
 STRING_AGG(value || '=' || CAST(n AS VARCHAR), '|' ORDER BY rank) FILTER (WHERE rank <= 5) AS top_values,
 {r('100.0E0 * SUM(n) FILTER (WHERE value IS NOT NULL) / SUM(n)')} AS reliability
FROM (SELECT *, CASE WHEN value IS NOT NULL THEN
  ROW_NUMBER() OVER (PARTITION BY col, value IS NULL ORDER BY n DESC, value) END AS rank
 FROM ({value_counts(TEXTS, 'properties')}) v) x GROUP BY col"""
    )
    sql["null_pairs"] = RAW + "SELECT * FROM (" + union(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, COUNT(*) FILTER (WHERE {a} IS NULL AND {b} IS NULL) AS both_null,"
        f" {r(f'100.0E0 * COUNT(*) FILTER (WHERE {a} IS NULL AND {b} IS NULL) / COUNT(*)')} AS percent FROM properties"
        for a, b in pairs
    ) + ") p WHERE both_null > 0"
    pattern = " || ".join(f"(CASE WHEN {c} IS NULL THEN '1' ELSE '0' END)" for c in PROPERTY_COLUMNS)
    sql["null_mask_patterns"] = RAW + f"SELECT {pattern} AS pattern, COUNT(*) AS rows FROM properties GROUP BY 1"
    flag = lambda c: f"(CASE WHEN {c} IS NULL THEN 1.0E0 ELSE 0.0E0 END)"
    sql["missing_corr"] = RAW + "SELECT column_a, column_b, CASE WHEN ISNAN(c) THEN NULL ELSE ROUND(c, 6) END AS correlation FROM (" + union(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, CORR({flag(a)}, {flag(b)}) AS c FROM properties" for a, b in pairs
    ) + ") x"
    sql["correlations"] = RAW + union(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {r(f'CORR({a}, {b})')} AS correlation FROM properties"
        for a, b in combinations(NUMBERS, 2)
    )
    wide = ["l_quantity", "l_extendedprice", "l_discount", "net", "gross"]
    sql["high_correlations"] = (
        "WITH priced_lines AS (SELECT l_quantity, l_extendedprice, l_discount, l_extendedprice * (1 - l_discount) AS net,"
        " l_extendedprice * (1 + l_tax) AS gross FROM lineitem) SELECT * FROM ("
        + union(
            f"SELECT '{a}' AS column_a, '{b}' AS column_b, {r(f'CORR({a}, {b})')} AS correlation FROM priced_lines"
            for a, b in combinations(wide, 2)
        )
        + ") x WHERE ABS(correlation) > 0.5"
    )
    rounded_score = f"{r('completeness')} AS completeness, {r('consistency')} AS consistency, {r('score')} AS score, state"
    sql["quality_score"] = RAW + f"SELECT {rounded_score} FROM ({score(PROPERTY_COLUMNS, 'properties', 'members')}) s"
    sql["dashboard_score"] = RAW + f"SELECT {rounded_score} FROM ({score(PROPERTY_COLUMNS, 'properties', 'extras')}) s"
    sql["zeros_nulls"] = RAW + union(
        f"SELECT '{c}' AS \"column\", "
        + (f"COUNT(*) FILTER (WHERE {c} = 0)" if c in NUMBERS else "CAST(0 AS BIGINT)")
        + f" AS zeros, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls FROM properties"
        for c in PROPERTY_COLUMNS
    )
    sql["dup_groups"] = RAW + f"SELECT {listed}, COUNT(*) AS members FROM properties GROUP BY {listed} HAVING COUNT(*) > 1"
    sql["dup_members"] = RAW + (
        "SELECT id_predio, avaluo_total, CASE WHEN COUNT(*) OVER (PARTITION BY id_predio) > 1 THEN 1 ELSE 0 END"
        " AS is_duplicate FROM properties"
    )
    sql["skew_kurtosis"] = RAW + union(
        f"""SELECT '{c}' AS "column", ROUND(AVG(POWER({c} - m, 3)) / POWER(AVG(POWER({c} - m, 2)), 1.5), 6) AS skewness,
 ROUND(AVG(POWER({c} - m, 4)) / POWER(AVG(POWER({c} - m, 2)), 2) - 3, 6) AS kurtosis
FROM properties, (SELECT AVG({c}) AS m FROM properties) a WHERE {c} IS NOT NULL"""
        for c in NUMBERS
    )

    pair = "column_a || ' ' || column_b"
    sections = {
        "table": ("profile_basic", "''", ["rows", "columns", "duplicate_extras", "duplicate_members"]),
        "nulls": ("profile_nulls", '"column"', ["nulls", "null_percent", "reliability"]),
        "numbers": (
            "profile_numeric",
            '"column"',
            ["count", "mean", "median", "std", "min", "max", "q25", "q75", "zeros", "zeros_percent", "negatives",
             "negatives_percent", "outliers", "outliers_percent", "reliability"],
        ),
        "categories": (
            "profile_categorical",
            '"column"',
            ["count", "distinct_values", "top_count", "top_percent", "diversity", "reliability"],
        ),
        "null_pairs": ("null_pairs", pair, ["both_null", "percent"]),
        "quality": ("quality_score", "''", ["completeness", "consistency", "score"]),
    }
    sql["profile_metrics"] = union(
        f"SELECT '{section}' AS section, {item} AS item, '{m}' AS metric, CAST(\"{m}\" AS DOUBLE) AS value"
        f" FROM ({sql[name]}) {section}_{i}"
        for section, (name, item, metrics) in sections.items()
        for i, m in enumerate(metrics)
    )

    sql["rename_project"] = (
        "SELECT l_orderkey AS id_predio, l_linenumber AS estrato, l_returnflag AS barrio_nombre,"
        " l_extendedprice AS avaluo_total, l_quantity AS area_construida, l_discount AS puntaje,"
        " l_linestatus AS tipo_construccion FROM lineitem"
    )
    sql["any_not_null"] = RAW + (
        "SELECT id_predio, estrato, avaluo_total, area_construida FROM properties"
        " WHERE area_construida IS NOT NULL OR puntaje IS NOT NULL OR tipo_construccion IS NOT NULL"
    )
    sql["row_cap"] = (
        "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem"
        " ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice LIMIT 50000"
    )
    sql["first_rows"] = "SELECT p_name, p_partkey, p_brand FROM part ORDER BY p_name, p_partkey LIMIT 20"
    sql["schema_check"] = RAW + union(
        f"SELECT '{c}' AS \"column\", '{expected}' AS expected, {actual} AS actual, '{state}' AS state, "
        + (f"COUNT({c})" if state != "FALTANTE" else "0 * COUNT(*)")
        + " AS present, CAST(0 AS BIGINT) AS lost FROM properties"
        for c, expected, actual, state in [
            ("id_predio", "string", "'string'", "OK"),
            ("estrato", "string", "'int'", "TIPO_INCORRECTO"),
            ("barrio_nombre", "string", "'string'", "OK"),
            ("avaluo_total", "double", "'double'", "OK"),
            ("area_construida", "double", "'double'", "OK"),
            ("puntaje", "double", "'double'", "OK"),
            ("tipo_construccion", "string", "'string'", "OK"),
            ("zona", "string", "CAST(NULL AS VARCHAR)", "FALTANTE"),
        ]
    )
    sql["type_changes"] = RAW + union(
        f"SELECT '{c}' AS \"column\", '{before}' AS \"before\", '{after}' AS \"after\","
        f" COUNT({c}) AS present_before, COUNT({c}) AS present_after FROM properties"
        for c, before, after in [
            ("id_predio", "string", "string"), ("estrato", "int", "string"), ("barrio_nombre", "string", "string"),
            ("avaluo_total", "double", "double"), ("area_construida", "double", "double"),
            ("puntaje", "double", "double"), ("tipo_construccion", "string", "string"),
        ]
    )
    sql["coerce_types"] = """SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
 CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN o_orderkey + 0.5E0
  WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN o_orderkey * -10.0E0
  ELSE CAST(o_orderkey AS DOUBLE) END AS measure FROM orders"""
    sql["exact_dedup"] = RAW + "SELECT DISTINCT * FROM properties"
    sql["pk_audit"] = RAW + """SELECT CAST(SUM(n) AS BIGINT) AS rows,
 CAST(COALESCE(SUM(n) FILTER (WHERE id_predio IS NULL), 0) AS BIGINT) AS null_keys, COUNT(id_predio) AS distinct_keys,
 CAST(COALESCE(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS duplicate_members,
 CASE WHEN COUNT(*) FILTER (WHERE n > 1) = 0 THEN 'OK' ELSE 'DUPLICADOS_CORREGIDOS' END AS state
FROM (SELECT id_predio, COUNT(*) AS n FROM (SELECT DISTINCT * FROM properties) d GROUP BY 1) k"""
    sql["pk_keep_first"] = RAW + f"""SELECT {listed} FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY id_predio ORDER BY {KEEP_ORDER}) AS rn FROM properties
 WHERE id_predio IS NOT NULL) x WHERE rn = 1"""
    kept = "NOT COALESCE(avaluo_total <= 0, FALSE)"
    sql["numeric_rules"] = RAW + union(
        f"SELECT '{rule}' AS rule, '{c}' AS \"column\", COUNT(*) FILTER (WHERE {test}) AS rows FROM properties"
        for rule, c, test in [
            ("positive", "avaluo_total", "avaluo_total <= 0"),
            ("in_range", "puntaje", f"{kept} AND (puntaje < 0 OR puntaje > 100)"),
            ("non_negative", "area_construida", f"{kept} AND area_construida < 0"),
            ("zero_marked", "area_construida", f"{kept} AND area_construida = 0"),
        ]
    )
    sql["null_out_of_range"] = RAW + f"""SELECT id_predio, avaluo_total,
 CASE WHEN area_construida >= 0 THEN area_construida END AS area_construida,
 CASE WHEN puntaje BETWEEN 0 AND 100 THEN puntaje END AS puntaje FROM properties WHERE {kept}"""
    sql["standardize_categories"] = RAW + """SELECT CAST(estrato AS VARCHAR) AS estrato,
 LOWER(TRIM(barrio_nombre)) AS barrio_nombre, LOWER(TRIM(tipo_construccion)) AS tipo_construccion, COUNT(*) AS n
FROM properties GROUP BY 1, 2, 3"""
    sql["category_changes"] = RAW + union(
        f"SELECT '{c}' AS \"column\", COUNT(DISTINCT {before}) AS distinct_before, COUNT(DISTINCT {after})"
        " AS distinct_after FROM properties"
        for c, before, after in [
            ("estrato", "CAST(estrato AS VARCHAR)", "TRIM(CAST(estrato AS VARCHAR))"),
            ("barrio_nombre", "barrio_nombre", "LOWER(TRIM(barrio_nombre))"),
            ("tipo_construccion", "tipo_construccion", "LOWER(TRIM(tipo_construccion))"),
        ]
    )
    sql["derived_features"] = RAW + """SELECT id_predio, CASE WHEN estrato = 0 THEN 1 ELSE 0 END AS es_comercial,
 CASE WHEN area_construida > 0 THEN avaluo_total / area_construida END AS avaluo_por_m2,
 0 AS area_construida_imputada, 0 AS puntaje_imputado, 0 AS tipo_construccion_imputado FROM properties"""
    summary = f"""SELECT i.n AS initial_rows, n_rows AS final_rows, i.n - n_rows AS removed_rows,
 100.0E0 * n_rows / i.n AS retention_percent, CAST(12 AS BIGINT) AS final_columns, null_cells AS final_nulls,
 extras AS final_duplicates FROM (SELECT COUNT(*) AS n FROM properties) i, ({health(CLEAN_COLUMNS, 'cleaned')}) h"""
    sql["cleaning_summary"] = CLEAN + (
        "SELECT initial_rows, final_rows, removed_rows, ROUND(retention_percent, 6) AS retention_percent,"
        f" final_columns, final_nulls, final_duplicates FROM ({summary}) s"
    )
    audit = {
        ("duplicates", "rows_before"): "(SELECT COUNT(*) FROM typed)",
        ("duplicates", "exact_duplicates"): "(SELECT COUNT(*) FROM typed) - (SELECT COUNT(*) FROM d)",
        ("duplicates", "rows_after"): "(SELECT COUNT(*) FROM d)",
        ("key", "rows"): "(SELECT COUNT(*) FROM d)",
        ("key", "null_keys"): "(SELECT COUNT(*) FROM d WHERE id_predio IS NULL)",
        ("key", "distinct_keys"): "(SELECT COUNT(DISTINCT id_predio) FROM d)",
        ("key", "duplicate_members"): (
            "(SELECT SUM(n) FROM (SELECT COUNT(*) AS n FROM d GROUP BY id_predio HAVING COUNT(*) > 1) g)"
        ),
    }
    sql["cleaning_audit"] = with_(PROPERTIES, TYPED, "\nd AS (SELECT DISTINCT * FROM typed)") + union(
        f"SELECT '{s}' AS section, '{m}' AS metric, CAST({v} AS DOUBLE) AS value" for (s, m), v in audit.items()
    )
    numbers = {
        "avaluo_total positive": "avaluo_total <= 0",
        "puntaje in_range": f"{kept} AND (puntaje < 0 OR puntaje > 100)",
        "area_construida non_negative": f"{kept} AND area_construida < 0",
        "area_construida zero_marked": f"{kept} AND area_construida = 0",
    }
    categories = {
        "estrato": "TRIM(estrato)",
        "barrio_nombre": "LOWER(TRIM(barrio_nombre))",
        "tipo_construccion": "LOWER(TRIM(tipo_construccion))",
    }
    summary_columns = [
        "initial_rows", "final_rows", "removed_rows", "retention_percent", "final_columns", "final_nulls", "final_duplicates",
    ]
    sql["cleaning_report"] = with_(PROPERTIES, TYPED, CLEANED, "\nd AS (SELECT DISTINCT * FROM typed)") + union(
        [
            f"SELECT '{s}' AS section, '{m}' AS metric, CAST({v} AS DOUBLE) AS value"
            for (s, m), v in audit.items()
        ]
        + [
            f"SELECT 'numbers', '{m}', CAST(COUNT(*) FILTER (WHERE {test}) AS DOUBLE) FROM ranked WHERE rn = 1"
            for m, test in numbers.items()
        ]
        + [
            f"SELECT 'categories', '{c} {when}', CAST(COUNT(DISTINCT {e}) AS DOUBLE) FROM repaired"
            for c, after in categories.items()
            for when, e in (("distinct_before", c), ("distinct_after", after))
        ]
        + [
            f"SELECT 'summary', '{c}', ROUND(CAST({c} AS DOUBLE), 6) FROM ({summary}) s" for c in summary_columns
        ]
    )
    sql["clean_chain"] = CLEAN + f"SELECT {', '.join(CLEAN_COLUMNS)} FROM cleaned"
    sql["date_standardize"] = """SELECT o_orderkey,
 CASE WHEN o_orderkey % 4 <> 3 THEN STRFTIME(o_orderdate, '%Y-%m-%d') END AS day FROM orders"""
    sql["precision_align"] = "SELECT p_partkey, ROUND(p_retailprice, 0) AS p_retailprice FROM part"
    sql["rule_checks"] = RAW + union(
        f"SELECT '{name}' AS rule, COUNT(*) FILTER (WHERE NOT COALESCE({test}, FALSE)) AS violations,"
        f" {r(f'100 - 100.0E0 * COUNT(*) FILTER (WHERE NOT COALESCE({test}, FALSE)) / COUNT(*)')} AS passed_percent"
        " FROM properties"
        for name, test in [
            ("key present", "id_predio IS NOT NULL"),
            ("size present", "area_construida IS NOT NULL"),
            ("score in range", "COALESCE(puntaje BETWEEN 0 AND 100, TRUE)"),
            ("value positive", "avaluo_total > 0"),
        ]
    )
    barrio, tipo = FINGERPRINT.format(c="barrio_nombre"), FINGERPRINT.format(c="tipo_construccion")
    sql["near_duplicates"] = RAW + f"""SELECT id_predio, avaluo_total, b AS barrio_nombre, t AS tipo_construccion,
 COUNT(*) AS members, COUNT(DISTINCT spelling) AS spellings FROM (
 SELECT id_predio, avaluo_total, {barrio} AS b, {tipo} AS t,
  ROW(barrio_nombre, tipo_construccion) AS spelling FROM properties) x
GROUP BY 1, 2, 3, 4 HAVING COUNT(*) > 1"""

    sql["exec_summary"] = CLEAN + (
        "SELECT n_rows AS rows, CAST(12 AS BIGINT) AS columns, ROUND(100 - 100.0E0 * null_cells / (n_rows * 12), 6)"
        f" AS completeness, extras AS duplicates FROM ({health(CLEAN_COLUMNS, 'cleaned')}) h"
    )
    sql["completeness_by_column"] = CLEAN + "SELECT \"column\", ROUND(c, 6) AS completeness, CASE WHEN c < 80 THEN 'red' WHEN c < 95 THEN 'orange' ELSE 'green' END AS colour FROM (" + union(
        f"SELECT '{c}' AS \"column\", 100.0E0 * COUNT({c}) / COUNT(*) AS c FROM cleaned" for c in CLEAN_COLUMNS
    ) + ") x"
    sql["stage_comparison"] = BASELINE + union(
        f"SELECT '{stage}' AS stage, null_cells AS nulls, extras AS duplicates, n_rows AS rows FROM ({health(columns, source)}) h"
        for stage, columns, source in [
            ("original", PROPERTY_COLUMNS, "properties"),
            ("cleaned", CLEAN_COLUMNS, "cleaned"),
            ("imputed", CLEAN_COLUMNS, "filled"),
        ]
    )
    sql["outlier_change"] = CLEAN + 'SELECT b."column", b.outliers AS outliers_before, a.outliers AS outliers_after FROM (' + union(
        numeric_row(c, "properties") for c in ("avaluo_total", "area_construida", "puntaje")
    ) + ") b JOIN (" + union(numeric_row(c, "cleaned") for c in ("avaluo_total", "area_construida", "puntaje")) + ') a ON a."column" = b."column"'
    runs = {"original": "1 original", "cleaned": "2 cleaned", "imputed": "3 imputed"}
    metrics = {"rows": "rows", "nulls": "null_cells", "duplicates": "duplicate_extras"}
    sql["quality_history"] = (
        "SELECT *, value - previous AS change FROM (SELECT *, LAG(value) OVER (PARTITION BY metric ORDER BY run) AS previous FROM ("
        + union(
            f"SELECT '{metric}' AS metric, CAST({column} AS DOUBLE) AS value, CASE stage "
            + " ".join(f"WHEN '{stage}' THEN '{run}'" for stage, run in runs.items())
            + f" END AS run FROM ({sql['stage_comparison']}) s{column}"
            for column, metric in metrics.items()
        )
        + ") m) t"
    )
    sql["imputation_counts"] = BASELINE + union(
        f"SELECT '{f.removesuffix('_imputada').removesuffix('_imputado')}' AS \"column\","
        f" CAST(SUM({f}) AS BIGINT) AS imputed FROM filled"
        for f in FLAGS
    )
    sql["baseline_impute"] = BASELINE + (
        "SELECT id_predio, barrio_nombre, ROUND(area_construida, 6) AS area_construida, area_construida_imputada FROM filled"
    )
    report = {
        "rows": "n_rows", "columns": "{n}", "null_cells": "null_cells", "duplicates": "extras",
        "completeness": "ROUND(100 - 100.0E0 * null_cells / (n_rows * {n}), 6)",
    }

    def report_sql(columns, source, extra=""):
        return union(
            [
                f"SELECT 'table' AS section, '' AS \"column\", '{m}' AS metric,"
                f" CAST({v.format(n=len(columns))} AS DOUBLE) AS value{extra} FROM ({health(columns, source)}) h"
                for m, v in report.items()
            ]
            + [
                f"SELECT 'column' AS section, '{c}' AS \"column\", 'completeness' AS metric,"
                f" {r(f'100 - 100.0E0 * COUNT(*) FILTER (WHERE {c} IS NULL) / COUNT(*)')} AS value{extra} FROM {source}"
                for c in columns
            ]
        )

    sql["health_report"] = CLEAN + report_sql(CLEAN_COLUMNS, "cleaned")
    sql["metrics_roundtrip"] = RAW + report_sql(PROPERTY_COLUMNS, "properties", ", 'r1' AS run")
    sql["null_matrix"] = RAW + "SELECT " + ", ".join(
        f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS {c}" for c in PROPERTY_COLUMNS
    ) + " FROM (SELECT * FROM properties ORDER BY " + ", ".join(f"{c} ASC NULLS LAST" for c in PROPERTY_COLUMNS) + " LIMIT 1000) x"
    sql["group_quality_states"] = RAW + """SELECT barrio_nombre, estrato, ROUND(share, 6) AS share,
 CASE WHEN share * 1.7E0 >= 90 THEN 'EXCELENTE' WHEN share * 1.7E0 >= 75 THEN 'BUENA' WHEN share * 1.7E0 >= 60
  THEN 'ACEPTABLE' ELSE 'CRÍTICA' END AS state,
 CASE WHEN share * 2 < 80 THEN 'red' WHEN share * 2 < 95 THEN 'orange' ELSE 'green' END AS colour
FROM (SELECT barrio_nombre, estrato, 100.0E0 * COUNT(*) FILTER (WHERE area_construida IS NOT NULL AND
  id_predio IS NOT NULL AND avaluo_total > 60000) / COUNT(*) AS share FROM properties GROUP BY 1, 2) g"""
    sql["run_summary"] = CLEAN + union(
        [
            f"SELECT 'profile' AS stage, '{c}' AS metric, ROUND(CAST({c} AS DOUBLE), 6) AS value"
            f" FROM ({score(PROPERTY_COLUMNS, 'properties', 'members')}) s"
            for c in ("completeness", "consistency", "score")
        ]
        + [
            f"SELECT 'cleaning' AS stage, '{c}' AS metric, ROUND(CAST({c} AS DOUBLE), 6) AS value FROM ({summary}) s"
            for c in summary_columns
        ]
    )
    sql["alerts"] = with_(PROPERTIES, TYPED, CLEANED, PRICED) + f"""SELECT metric, ROUND(value, 6) AS value, "limit" FROM (
 SELECT 'score' AS metric, score AS value, 60.0E0 AS "limit" FROM ({score(PROPERTY_COLUMNS, 'properties', 'members')}) a
 UNION ALL SELECT 'retention_percent', retention_percent, 90.0E0 FROM ({summary}) b
 UNION ALL SELECT 'r2', {MEASURES['r2']}, 0.6E0 FROM priced) x WHERE value < "limit" """
    sql["quality_trend"] = """SELECT run, metric, value,
 LAG(value) OVER (PARTITION BY metric ORDER BY run) AS previous,
 ROUND(value - LAG(value) OVER (PARTITION BY metric ORDER BY run), 6) AS change
FROM (SELECT STRFTIME(ts, '%Y-%m-%d') AS run, event_type AS metric, ROUND(AVG(value), 6) AS value
 FROM events GROUP BY 1, 2) d"""
    parts_sql = f"""SELECT 100.0E0 * (7 * COUNT(*) - ({nulls_of(PROPERTY_COLUMNS, 'properties')})) / (7 * COUNT(*)) AS completeness,
 100.0E0 * COUNT(*) FILTER (WHERE avaluo_total > 0) / COUNT(*) AS consistency,
 100.0E0 * COUNT(*) FILTER (WHERE puntaje BETWEEN 0 AND 100) / COUNT(*) AS validity,
 100.0E0 * COUNT(*) FILTER (WHERE barrio_nombre = TRIM(barrio_nombre)) / COUNT(*) AS format FROM properties"""
    sql["four_part_score"] = RAW + f"""SELECT {r('completeness')} AS completeness, {r('consistency')} AS consistency,
 {r('validity')} AS validity, {r('format')} AS format,
 {r('0.4E0 * completeness + 0.3E0 * consistency + 0.2E0 * validity + 0.1E0 * format')} AS score FROM ({parts_sql}) p"""

    sql["lookup_two_tier"] = with_(FEATURES) + "SELECT id, stratum, base_count, base_value, tier FROM found"
    sql["shipped_lookup"] = shipped_sql()
    sql["near_spellings"] = """WITH RECURSIVE brands AS (
 SELECT p_type, CASE p_partkey % 6 WHEN 0 THEN substr(p_brand, 1, 3) || 'e' || substr(p_brand, 5) WHEN 1 THEN p_brand || 'x'
  WHEN 2 THEN substr(p_brand, 2) ELSE p_brand END AS value FROM part
), counts AS (SELECT p_type, value, COUNT(*) AS rows FROM brands GROUP BY 1, 2),
links AS (
 SELECT a.p_type, a.value, b.value AS other FROM counts a JOIN counts b
 ON a.p_type = b.p_type AND a.value <> b.value AND levenshtein(a.value, b.value) <= 1
), reach AS (
 SELECT p_type, value, value AS root FROM (SELECT DISTINCT p_type, value FROM links) v
 UNION SELECT links.p_type, links.value, reach.root FROM links JOIN reach ON links.p_type = reach.p_type AND links.other = reach.value
)
SELECT reach.p_type, reach.value, rows, MIN(root) AS "group" FROM reach JOIN counts
 ON counts.p_type = reach.p_type AND counts.value = reach.value GROUP BY 1, 2, 3"""
    sql["critical_columns_default"] = """SELECT * FROM (
 SELECT 'l_tax' AS "column", ROUND(100.0E0 * COUNT(*) FILTER (WHERE l_partkey % 3 = 0) / COUNT(*), 6) AS null_percent FROM lineitem
 UNION ALL SELECT 'l_discount', ROUND(100.0E0 * COUNT(*) FILTER (WHERE l_partkey % 7 = 0) / COUNT(*), 6) FROM lineitem) c WHERE null_percent > 20"""
    sql["neighbourhood_enrich"] = with_(FEATURES) + (
        "SELECT id, nombre, stratum, base_count, base_value, tier, ROUND(area, 6) AS area, row_count, total_value,"
        " average_value, ROUND(density, 6) AS density, prestige, score FROM enriched"
    )
    sql["prestige_v1"] = """SELECT p_partkey, stratum, value,
 CASE WHEN stratum >= 5 OR value >= 300000000 THEN 'PREMIUM' WHEN stratum = 4 OR value >= 250000000 THEN 'ALTO'
  WHEN stratum = 3 OR value >= 200000000 THEN 'MEDIO ALTO' WHEN stratum = 2 OR value >= 150000000 THEN 'MEDIO'
  ELSE 'BAJO' END AS prestige,
 CASE WHEN stratum >= 5 OR value >= 300000000 THEN 5 WHEN stratum = 4 OR value >= 250000000 THEN 4
  WHEN stratum = 3 OR value >= 200000000 THEN 3 WHEN stratum = 2 OR value >= 150000000 THEN 2 ELSE 1 END AS score
FROM (SELECT p_partkey, p_size % 7 AS stratum, (p_partkey % 100) * 4000000 AS value FROM part) p"""
    sql["prestige_v2"] = """SELECT p_partkey, stratum,
 CASE WHEN stratum >= 5 THEN 'PREMIUM' WHEN stratum = 4 THEN 'ALTO' WHEN stratum = 3 THEN 'MEDIO ALTO'
  WHEN stratum = 2 THEN 'MEDIO' ELSE 'BAJO' END AS prestige,
 CASE WHEN stratum >= 5 THEN 5 WHEN stratum = 4 THEN 4 WHEN stratum = 3 THEN 3 WHEN stratum = 2 THEN 2 ELSE 1 END AS score
FROM (SELECT p_partkey, p_size % 7 AS stratum FROM part) p"""
    sql["top_groups"] = CLEAN + """SELECT barrio_nombre AS "group", COUNT(id_predio) AS row_count,
 ROUND(SUM(avaluo_total), 2) AS total_value, ROUND(SUM(avaluo_total) / COUNT(id_predio), 6) AS average_value
FROM cleaned GROUP BY 1 ORDER BY row_count DESC, "group" ASC NULLS LAST LIMIT 12"""
    sql["group_totals"] = RAW + """SELECT barrio_nombre AS "group", COUNT(id_predio) AS row_count,
 ROUND(SUM(area_construida), 2) AS total_value, ROUND(SUM(area_construida) / COUNT(id_predio), 6) AS average_value
FROM properties GROUP BY 1"""
    sql["group_stats"] = RAW + """SELECT barrio_nombre AS "group", COUNT(id_predio) AS row_count,
 ROUND(SUM(avaluo_total), 2) AS total_value, ROUND(AVG(avaluo_total), 6) AS mean_value,
 ROUND(AVG(area_construida), 6) AS mean_area, ROUND(AVG(estrato), 6) AS mean_level FROM properties GROUP BY 1"""
    sql["class_summary"] = """WITH classes AS (SELECT * FROM (VALUES (1, 'PREMIUM'), (2, 'ALTO'), (3, 'MEDIO ALTO'),
 (4, 'MEDIO'), (5, 'BAJO')) v(position, label)),
parts AS (SELECT p_partkey, p_size, CASE WHEN p_size % 4 >= 5 THEN 'PREMIUM' WHEN p_size % 4 = 4 THEN 'ALTO'
 WHEN p_size % 4 = 3 THEN 'MEDIO ALTO' WHEN p_size % 4 = 2 THEN 'MEDIO' ELSE 'BAJO' END AS label FROM part)
SELECT position, c.label, COUNT(p_partkey) AS members, CAST(COALESCE(SUM(p_size), 0) AS BIGINT) AS size_total,
 CAST(COALESCE(SUM(p_partkey), 0) AS BIGINT) AS keys
FROM classes c LEFT JOIN parts p ON c.label = p.label GROUP BY 1, 2"""
    sql["global_totals"] = with_(FEATURES) + """SELECT COUNT(DISTINCT nombre) AS groups, CAST(SUM(row_count) AS BIGINT) AS row_count,
 CAST(SUM(total_value) AS BIGINT) AS total_value, ROUND(CAST(SUM(total_value) AS DOUBLE) / SUM(row_count), 6) AS average_value
FROM enriched"""
    sql["fact_totals"] = RAW + """SELECT COUNT(*) AS rows, COUNT(DISTINCT barrio_nombre) AS groups,
 ROUND(AVG(avaluo_total), 6) AS mean_value, ROUND(AVG(estrato), 6) AS mean_level FROM properties"""
    sql["scaled_size"] = with_(BRANDS) + (
        "SELECT p_brand, row_count, ROUND(300.0E0 + row_count / CAST((SELECT MAX(row_count) FROM brands) AS DOUBLE)"
        " * 1200.0E0, 6) AS size FROM brands"
    )
    sql["total_value"] = with_(BRANDS) + (
        "SELECT p_brand, quantity, row_count, CAST(quantity * row_count AS BIGINT) AS total_value FROM brands"
    )
    heat_key = "(p_brand || '#' || CAST(point AS VARCHAR))"
    sql["heat_points"] = with_(
        BRANDS,
        "\npoints AS (SELECT p_brand, number, UNNEST(RANGE(CAST(TRUNC(row_count / 100.0E0) AS BIGINT))) AS point FROM brands)",
    ) + f"""SELECT p_brand AS name, point,
 ROUND(6.0E0 + number / 100.0E0 + {NORMAL.format(key=heat_key, seed='lat', scale='0.02E0')}, 6) AS lat,
 ROUND(-75.0E0 - number / 100.0E0 + {NORMAL.format(key=heat_key, seed='lon', scale='0.02E0')}, 6) AS lon,
 ROUND((CASE WHEN number % 6 + 1 >= 5 THEN 5 ELSE number % 6 + 1 END) / 5.0E0, 6) AS weight FROM points"""
    part_key = "CAST(p_partkey AS VARCHAR)"
    sql["jittered_centres"] = f"""SELECT p_partkey,
 ROUND(6.2442E0 + {NORMAL.format(key=part_key, seed='lat', scale='0.05E0')}, 6) AS lat,
 ROUND(-75.5812E0 + {NORMAL.format(key=part_key, seed='lon', scale='0.05E0')}, 6) AS lon FROM part"""
    sql["group_attach"] = with_(NATIONS) + (
        "SELECT n_nationkey, fact_rows, fact_value, fact_mean_area FROM dimension LEFT JOIN totals ON UPPER(TRIM(nombre)) = name"
    )
    sql["unmatched_groups"] = with_(NATIONS) + (
        "SELECT name, fact_rows, fact_value, fact_mean_area FROM totals"
        " WHERE name NOT IN (SELECT UPPER(TRIM(nombre)) FROM dimension)"
    )

    sql["split_hash"] = split_sql("(SELECT o_orderkey FROM orders) o", "o_orderkey", None, "CEIL(n * 0.2)")
    sql["split_stratified"] = split_sql("(SELECT p_partkey, p_type FROM part) p", "p_partkey", "p_type", "FLOOR(n * 0.2)")
    sql["fold_assign"] = f"SELECT p_partkey, CAST({digest_number(part_key, '42')} % 5 AS INTEGER) AS fold FROM part"
    scaled = ["avaluo_total", "area_construida", "puntaje"]
    # each step once: the engine would otherwise expand the steps wherever they are named
    sql["median_fill_scale"] = RAW.replace("properties AS (", "properties AS MATERIALIZED (") + (
        ", medians AS MATERIALIZED (SELECT " + ", ".join(f"QUANTILE_CONT({c}, 0.5) AS m_{c}" for c in scaled) + " FROM properties),"
        " full_ AS MATERIALIZED (SELECT id_predio, " + ", ".join(f"COALESCE({c}, m_{c}) AS {c}" for c in scaled) + " FROM properties, medians),"
        " moments AS MATERIALIZED (SELECT " + ", ".join(f"AVG({c}) AS a_{c}, STDDEV_POP({c}) AS s_{c}" for c in scaled) + " FROM full_)"
        " SELECT id_predio, " + ", ".join(f"ROUND(({c} - a_{c}) / s_{c}, 6) AS {c}" for c in scaled) + " FROM full_, moments"
    )
    sql["category_cap"] = category_cap_sql()
    sql["class_weights"] = RAW + """SELECT tipo_construccion AS label, COUNT(*) AS n, ROUND((SELECT COUNT(tipo_construccion) FROM properties)
 / CAST((SELECT COUNT(DISTINCT tipo_construccion) FROM properties) * COUNT(*) AS DOUBLE), 6) AS weight
FROM properties WHERE tipo_construccion IS NOT NULL GROUP BY 1"""
    sql["regression_metrics"] = with_(PRICED) + "SELECT l_returnflag, " + ", ".join(
        f"ROUND({m}, 6) AS {name}" for name, m in MEASURES.items()
    ) + " FROM priced GROUP BY 1"
    columns = "ROUND({p}, 6) AS precision, ROUND({q}, 6) AS recall, ROUND({f}, 6) AS f1"
    weighted = {k: f"SUM({k} * support) / SUM(support)" for k in "pqf"}
    accuracy = "SUM(hits) / CAST(SUM(support) AS DOUBLE)"
    sql["classification_metrics"] = with_(PRICED, CLASSES) + union(
        [
            f"SELECT label, {columns.format(p='p', q='q', f='f')}, support FROM scores",
            f"SELECT 'macro avg', {columns.format(p='AVG(p)', q='AVG(q)', f='AVG(f)')}, CAST(SUM(support) AS BIGINT) FROM scores",
            f"SELECT 'weighted avg', {columns.format(**weighted)}, CAST(SUM(support) AS BIGINT) FROM scores",
            f"SELECT 'accuracy', {columns.format(p=accuracy, q=accuracy, f=accuracy)}, CAST(SUM(support) AS BIGINT) FROM scores",
        ]
    )
    sql["confusion"] = with_(PRICED) + (
        "SELECT l_returnflag AS actual, guess AS predicted, COUNT(*) AS n FROM priced GROUP BY 1, 2"
    )
    sql["cross_validation"] = with_(FOLD_SCORES) + "SELECT position, candidate, cv_mean, cv_std FROM cv"
    sql["model_select"] = with_(FOLD_SCORES) + (
        "SELECT position, candidate, cv_mean, cv_std FROM cv ORDER BY exact DESC, position LIMIT 1"
    )

    targets = ["area_construida", "puntaje", "tipo_construccion"]
    sql["impute_contract"] = CLEAN + "SELECT id_predio, " + ", ".join(
        [f"{c} AS kept_{c}" for c in targets]
        + [f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS {f}" for c, f in zip(targets, FLAGS, strict=True)]
    ) + ", 1 AS whole FROM cleaned"

    for name, c, flag in zip(["impute_numeric", "impute_bounded", "impute_category"], targets, FLAGS, strict=True):
        sql[name] = CLEAN + (
            f"SELECT id_predio, {c} AS kept, CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS {flag}, 1 AS whole, 1 AS best FROM cleaned"
        )
    sql["impute_chain"] = sql["impute_contract"]
    known = "(SELECT id_predio, tipo_construccion FROM cleaned WHERE tipo_construccion IS NOT NULL) p"
    sql["boosted_classes"] = CLEAN + f"""SELECT tipo_construccion AS label, COUNT(*) AS n, 0 AS broken, MAX(COUNT(*)) OVER () AS commonest,
 1 AS falls, 1 AS beats FROM ({split_sql(known, "id_predio", "tipo_construccion", "FLOOR(n * 0.2)")}) s WHERE is_test = 1 GROUP BY 1"""

    sql["conformal_bins"] = conformal_sql(
        "fold <> 0",
        """SELECT bin, ROUND(CASE bin WHEN 1 THEN e1 WHEN 2 THEN e2 WHEN 3 THEN e3 END, 6) AS low,
 ROUND(CASE bin WHEN 0 THEN e1 WHEN 1 THEN e2 WHEN 2 THEN e3 END, 6) AS high, n AS rows, ROUND(radius, 6) AS radius,
 COALESCE(held_rows, 0) AS held_rows, ROUND(covered, 6) AS covered FROM radii LEFT JOIN (
  SELECT bin, COUNT(*) AS held_rows, AVG(CASE WHEN res <= radius THEN 1.0E0 ELSE 0.0E0 END) AS covered
  FROM binned JOIN radii USING (bin) WHERE y IS NOT NULL AND fold = 0 GROUP BY 1
 ) t USING (bin), edges""",
    )
    sql["fill_intervals"] = conformal_sql(
        "TRUE",
        """SELECT o_orderkey, ROUND(p, 4) AS predicted, ROUND(COALESCE(y, p), 4) AS price,
 CASE WHEN y IS NULL THEN ROUND(p - radius, 4) END AS lower, CASE WHEN y IS NULL THEN ROUND(p + radius, 4) END AS upper
FROM binned JOIN radii USING (bin)""",
    )
    sql["level_changes"] = """WITH RECURSIVE daily AS (
 SELECT STRFTIME(ts, '%Y-%m-%d') AS run, event_type AS metric, ROUND(AVG(value), 6) AS value FROM events GROUP BY 1, 2
), numbered AS MATERIALIZED (SELECT *, ROW_NUMBER() OVER (PARTITION BY metric ORDER BY run) AS n FROM daily WHERE value IS NOT NULL),
base AS MATERIALIZED (SELECT metric, AVG(value) AS centre, STDDEV_SAMP(value) AS sd FROM numbered WHERE n <= 10 GROUP BY 1),
z AS MATERIALIZED (SELECT metric, run, value, n, centre, (value - centre) / sd AS z FROM numbered JOIN base USING (metric)),
sums AS (
 SELECT metric, run, value, n, centre, GREATEST(0, z - 0.5) AS up, GREATEST(0, -z - 0.5) AS down FROM z WHERE n = 1
 UNION ALL
 SELECT z.metric, z.run, z.value, z.n, z.centre, GREATEST(0, up + z.z - 0.5), GREATEST(0, down - z.z - 0.5)
 FROM sums JOIN z ON z.metric = sums.metric AND z.n = sums.n + 1
)
SELECT run, metric, value, ROUND(centre, 6) AS centre, ROUND(up, 6) AS up, ROUND(down, 6) AS down, up > 4 OR down > 4 AS alarm FROM sums"""

    gaps = "(SELECT event_type, ts, CASE WHEN event_id % 23 <> 0 THEN value END AS value, CAST(user_id AS DOUBLE) AS user_id FROM events) e"
    sql["sketched_months"] = union([
        f"""SELECT STRFTIME(ts, '%Y-%m') AS month, event_type, '{c}' AS "column", COUNT(*) AS rows, COUNT(*) - COUNT({c}) AS nulls,
 ROUND(100.0E0 * (COUNT(*) - COUNT({c})) / COUNT(*), 6) AS null_percent, COUNT(*) FILTER (WHERE {c} = 0) AS zeros,
 ROUND(MIN({c}), 6) AS min, ROUND(MAX({c}), 6) AS max, ROUND(AVG({c}), 6) AS mean, ROUND(STDDEV_SAMP({c}), 6) AS std,
 COUNT({c}) AS sketched FROM {gaps} GROUP BY 1, 2"""
        for c in ("value", "user_id")
    ])
    sql["sketch_errors"] = union([
        f"""SELECT '{c}' AS "column", rank, (SELECT COUNT(DISTINCT {c}) FROM {gaps}) AS distinct_values, 1 AS distinct_held,
 1 AS rank_held FROM (VALUES (0.25E0), (0.5E0), (0.75E0)) r (rank)"""
        for c in ("value", "user_id")
    ])

    # two nested patterns: the likelihood has a closed form, and only the column without gaps tells them apart
    sql["missing_mechanism"] = RAW + """, groups AS (
 SELECT area_construida IS NULL AS gap, COUNT(*) AS n, AVG(avaluo_total) AS m FROM properties GROUP BY 1
), overall AS (SELECT AVG(avaluo_total) AS m0, VAR_POP(avaluo_total) AS v0 FROM properties),
test AS (SELECT CAST(SUM(n) AS BIGINT) AS rows, COUNT(*) AS patterns, SUM(n * (m - m0) * (m - m0) / v0) AS statistic FROM groups, overall)
SELECT rows, patterns, ROUND(statistic, 4) AS statistic, 1 AS degrees, CASE WHEN statistic > 3.841458820694124E0 THEN 1 ELSE 0 END AS rejected FROM test"""

    line = ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity"]
    sql["found_dependencies"] = dependencies_sql("lineitem", line, 1.0)

    sql["csv_roundtrip"] = """SELECT *, CASE c_custkey % 7 WHEN 0 THEN '  padded ' || c_name || chr(9) || ' ' WHEN 1 THEN '' WHEN 2 THEN NULL
 WHEN 3 THEN 'say "' || c_name || '", twice, "x"'
 WHEN 4 THEN 'first line' || chr(10) || 'second ' || c_name || chr(13) || chr(10) || chr(10) || 'last'
 WHEN 5 THEN 'back' || chr(92) || 'slash ' || chr(92) || '"' || c_name || chr(92) ELSE '# ''plain'', text' END AS note FROM customer"""
    sql["geojson_roundtrip"] = """SELECT p_name AS nombre, CAST(p_partkey AS VARCHAR) AS codigo, p_retailprice AS area,
 CAST(p_partkey AS DOUBLE) AS lon, CAST(p_size AS DOUBLE) AS lat FROM part"""
    plots = """WITH plots AS (
 SELECT p_partkey, p_size, p_size + 1 + CASE WHEN p_partkey % 97 = 0 THEN 300 ELSE 0 END AS w, p_partkey % 100 * 20 AS x,
  CAST(FLOOR(p_partkey / 100) AS BIGINT) * 20 AS y FROM part
)"""
    sql["shape_measures"] = plots + """, parts AS (
 SELECT p_partkey, x, y, w, 2.5E0 * w * w AS outer_area, CASE WHEN p_size % 5 = 0 THEN w * w / 2.0E0 ELSE 0.0E0 END AS hole FROM plots
)
SELECT p_partkey, outer_area - hole AS area, ROUND((outer_area * (x + 11.0E0 * w / 15.0E0) - hole * (x + w / 3.0E0)) / (outer_area - hole), 4) AS cx,
 ROUND((outer_area * (y + 13.0E0 * w / 15.0E0) - hole * (y + w / 3.0E0)) / (outer_area - hole), 4) AS cy FROM parts"""
    sql["located_customers"] = plots + """, places AS (
 SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_custkey * 7919 % 2000 + 0.25E0 END AS x,
  CAST(FLOOR(c_custkey / 75) AS BIGINT) * 20 + c_custkey * 31 % 41 + 0.5E0 AS y FROM customer
), met AS (
 SELECT c_custkey, p_partkey FROM (SELECT c_custkey, p_partkey, p_size, w, c.x - p.x AS dx, c.y - p.y AS dy FROM places c
  JOIN plots p ON c.x >= p.x AND c.x <= p.x + 2 * w AND c.y >= p.y AND c.y <= p.y + 2 * w) m
 WHERE dx - dy < w AND dx + 2 * dy < 4 * w
  AND NOT (p_size % 5 = 0 AND dx + dy < w)
)
SELECT c.c_custkey, c.x, c.y, m.p_partkey, COALESCE(m.plots, 0) AS plots FROM places c
LEFT JOIN (SELECT c_custkey, MIN(p_partkey) AS p_partkey, COUNT(*) AS plots FROM met GROUP BY c_custkey) m ON c.c_custkey = m.c_custkey"""
    sql["sample_generator"] = sample_sql()
    sql["keyed_stream"] = """SELECT user_id, COUNT(*) AS rows, COUNT(*) - COUNT(v) AS nulls, ROUND(AVG(v) + 1.0E-9, 6) AS mean, ROUND(STDDEV_SAMP(v), 6) AS std,
 ROUND(MIN(v), 6) AS low, ROUND(MAX(v), 6) AS high, STRFTIME(MIN(ts), '%Y-%m-%d %H:%M:%S') AS "first",
 STRFTIME(MAX(ts), '%Y-%m-%d %H:%M:%S') AS "last", CASE WHEN COUNT(*) > 1 THEN 1 ELSE 0 END AS repeated
FROM (SELECT *, CASE WHEN event_id % 11 <> 0 THEN value END AS v FROM events) e GROUP BY 1"""
    outside = "(value < -50 OR value > 200)"
    sql["stream_quality"] = f"""SELECT STRFTIME(ts, '%Y-%m-%d') AS window_start, event_type, COUNT(*) AS rows,
 COUNT(*) FILTER (WHERE value IS NULL) AS nulls, COUNT(*) FILTER (WHERE value = 0) AS zeros,
 COUNT(*) FILTER (WHERE {outside}) AS outliers, ROUND(100 - 100.0E0 * (COUNT(*) FILTER (WHERE value IS NULL)
  + COUNT(*) FILTER (WHERE value = 0) + COUNT(*) FILTER (WHERE {outside})) / COUNT(*), 6) AS reliability
FROM events GROUP BY 1, 2"""
    return sql
