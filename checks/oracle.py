"""SQL that computes the same results as the registered queries, for DuckDB."""

from __future__ import annotations

from parcelry.contract import NUMERIC_FEATURES
from parcelry.operators import drift
from checks import queries as q

LISTINGS = """lines AS (
  SELECT l_orderkey, count(*)::DOUBLE AS bedrooms, max(l_quantity) / 10 AS bathrooms,
         sum(l_quantity) AS living_area, max(l_extendedprice) AS normalized_lot_area_value
  FROM lineitem GROUP BY l_orderkey
), listings AS (
  SELECT o_orderkey AS property_id, o_orderdate::DATE AS snapshot_date, c_mktsegment AS city,
         n_name AS vegas_district,
         CASE WHEN o_orderkey % 5 <> 0 THEN 35.5::DOUBLE + n_nationkey * 0.25::DOUBLE
              + (o_orderkey % 100) / 1000.0::DOUBLE END AS latitude,
         CASE WHEN o_orderkey % 5 <> 0 THEN -115.5::DOUBLE + n_nationkey * 0.25::DOUBLE
              + (o_orderkey % 100) / 1000.0::DOUBLE END AS longitude,
         CASE WHEN o_orderkey % 17 <> 0 THEN o_orderpriority END AS property_type,
         o_totalprice AS price, bedrooms, bathrooms, living_area, normalized_lot_area_value,
         o_orderstatus AS listing_status
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN lines ON o_orderkey = l_orderkey
)"""

PRICED = """priced AS (
  SELECT o_orderkey AS property_id, o_orderdate::DATE AS snapshot_date, o_totalprice AS price,
         CASE WHEN o_orderkey % 17 <> 0 THEN o_orderpriority END AS property_type,
         o_orderstatus AS listing_status
  FROM orders
)"""

CENTROIDS = f"""centroids AS (
  SELECT CASE WHEN n_nationkey = {q.shapes.UNPLACED_NATION} THEN 'Old ' || n_name ELSE n_name END AS n_name,
         35.5::DOUBLE + n_nationkey * 0.25::DOUBLE AS c_lat, -115.5::DOUBLE + n_nationkey * 0.25::DOUBLE AS c_lon
  FROM nation
)"""

PAIRS = """pairs AS (
  SELECT o_orderkey AS property_id, o_totalprice AS actual,
         CASE WHEN o_orderkey % 97 = 0 THEN -1000.0::DOUBLE
              ELSE o_totalprice * (1.0::DOUBLE + ((o_orderkey % 613) - 306) / 1000.0::DOUBLE
                   * (0.25::DOUBLE + o_totalprice / 400000.0::DOUBLE)) END AS prediction
  FROM orders
), errors AS (
  SELECT *, greatest(prediction, 0.0::DOUBLE) AS p,
         abs(actual - greatest(prediction, 0.0::DOUBLE)) / greatest(abs(actual), 1.0::DOUBLE) AS error
  FROM pairs
)"""

REQUESTS = f"""{LISTINGS}, requests AS (
  SELECT property_id,
         CASE WHEN property_id % 23 = 0 THEN -1.0::DOUBLE WHEN property_id % 29 = 0 THEN 2.5::DOUBLE
              ELSE bedrooms END AS bedrooms,
         bathrooms,
         CASE WHEN property_id % 31 <> 0 THEN living_area END AS livingarea,
         CASE WHEN property_id % 3 = 0 THEN 5.0::DOUBLE END AS living_area,
         latitude, longitude,
         CASE WHEN property_id % 7 <> 0 THEN normalized_lot_area_value END AS normalized_lot_area_value,
         CASE WHEN property_id % 37 = 0 THEN '' ELSE property_type END AS propertytype,
         vegas_district
  FROM listings
)"""

VERSIONS = """versions AS (
  SELECT 'model_' || o_custkey AS model_name, o_orderkey AS version, 'run_' || o_orderkey AS run_id,
         CASE o_orderstatus WHEN 'F' THEN 'Production' WHEN 'O' THEN 'Staging' ELSE 'Archived' END AS stage
  FROM orders
), runs AS (
  SELECT 'run_' || o_orderkey AS run_id,
         CASE WHEN o_orderkey % 11 = 0 THEN 'test_rmse' ELSE 'test_r2' END AS metric_name,
         (o_orderkey % 64) / 64.0::DOUBLE AS metric_value
  FROM orders
  UNION ALL
  SELECT 'candidate_' || c_custkey, 'test_r2', CASE WHEN c_custkey % 13 <> 0 THEN (c_custkey % 32) / 32.0::DOUBLE END
  FROM customer
), production AS (
  SELECT v.model_name, v.version, v.run_id, r.metric_value AS production_metric
  FROM (SELECT model_name, max(version) AS version, arg_max(run_id, version) AS run_id
        FROM versions WHERE stage = 'Production' GROUP BY model_name) v
       LEFT JOIN runs r ON r.run_id = v.run_id AND r.metric_name = 'test_r2'
), gated AS (
  SELECT 'model_' || c_custkey AS model_name, 'candidate_' || c_custkey AS run_id,
         r.metric_value AS candidate_metric, p.production_metric,
         p.model_name IS NULL OR (r.metric_value IS NOT NULL AND coalesce(r.metric_value - p.production_metric > 0.02::DOUBLE, true)) AS passed, CASE WHEN p.model_name IS NULL THEN 'no production version' WHEN r.metric_value IS NULL THEN 'candidate lacks the metric'
              WHEN p.production_metric IS NULL THEN 'production lacks the metric'
              WHEN r.metric_value - p.production_metric > 0.02::DOUBLE THEN 'gain above the threshold' ELSE 'gain not above the threshold' END AS reason
  FROM customer LEFT JOIN runs r ON r.run_id = 'candidate_' || c_custkey AND r.metric_name = 'test_r2'
       LEFT JOIN production p ON p.model_name = 'model_' || c_custkey
), last AS (
  SELECT model_name, max(version) AS version FROM versions GROUP BY model_name
)"""

EARLY = f"o_orderdate < TIMESTAMP '{q.SPLIT_DATE}'"
LATE = f"o_orderdate >= TIMESTAMP '{q.SPLIT_DATE}'"


def grid(parts: int) -> str:
    return "[" + ", ".join(f"{i / parts!r}::DOUBLE" for i in range(parts + 1)) + "]"


def bucket(x: str, edges: str) -> str:
    """0-based bucket, the last one closed; x must lie within the edges."""
    return f"least(len(list_filter({edges}, lambda e: e <= {x})), len({edges}) - 1) - 1"


def psi_parts(reference: str, current: str, clipped: bool) -> str:
    """CTEs ending in scored(psi, reference_rows, current_rows) for two queries giving x."""
    inside = "greatest(least(x, ed[-1]), ed[1])" if clipped else "x"
    return f"""ref AS ({reference}), cur AS ({current}),
e AS (SELECT list_sort(list_distinct(quantile_cont(x, {grid(10)}))) AS ed FROM ref),
rb AS (SELECT {bucket('x', 'ed')} AS b, count(*) AS n FROM ref, e GROUP BY ALL),
cb AS (SELECT {bucket(inside, 'ed')} AS b, count(*) AS n FROM cur, e
       WHERE {inside} BETWEEN ed[1] AND ed[-1] GROUP BY ALL),
spine AS (SELECT unnest(range(len(ed) - 1)) AS b FROM e),
counts AS (SELECT coalesce(rb.n, 0) AS r, coalesce(cb.n, 0) AS c
           FROM spine LEFT JOIN rb USING (b) LEFT JOIN cb USING (b)),
shares AS (SELECT CASE WHEN r = 0 THEN 1e-6 ELSE r / sum(r) OVER () END AS r,
                  CASE WHEN c = 0 THEN 1e-6 ELSE c / sum(c) OVER () END AS c FROM counts),
scored AS (SELECT round(sum((r - c) * ln(r / c)), 9) AS psi,
                  (SELECT count(*) FROM ref) AS reference_rows,
                  (SELECT count(*) FROM cur) AS current_rows FROM shares)"""


def early_late(x: str, clipped: bool = False, raised: str = "") -> str:
    current = x.replace("o_totalprice", f"o_totalprice{raised}")
    return psi_parts(
        f"SELECT {x} AS x FROM orders WHERE {EARLY}", f"SELECT {current} AS x FROM orders WHERE {LATE}", clipped
    )


def verdict(raised: str) -> str:
    return f"""WITH {early_late('ln(1 + o_totalprice)', True, raised)},
levels AS (SELECT psi, CASE WHEN psi >= 0.02 THEN 'high' WHEN psi >= 0.01 THEN 'moderate' ELSE 'none' END AS drift_level
           FROM scored),
decided AS (SELECT *, drift_level <> 'none' AND psi >= 0.01 AS should_retrain FROM levels)
SELECT should_retrain, psi, 0.01::DOUBLE AS psi_threshold, drift_level,
       (SELECT count(*) FROM orders WHERE {LATE}) AS current_row_count,
       (SELECT count(*) FROM orders WHERE {EARLY}) AS reference_row_count,
       (SELECT round(median(o_totalprice{raised}), 4) FROM orders WHERE {LATE}) AS current_price_median,
       (SELECT round(median(o_totalprice), 4) FROM orders WHERE {EARLY}) AS reference_price_median,
       (SELECT strftime(max(o_orderdate), '%Y-%m-%d') FROM orders WHERE {EARLY}) AS reference_snapshot_date,
       (SELECT strftime(max(o_orderdate), '%Y-%m-%d') FROM orders WHERE {LATE}) AS current_snapshot_date,
       CASE WHEN drift_level = 'none'
            THEN printf('No significant drift (PSI=%.4f). Retraining skipped.', psi)
            ELSE printf('%s drift (PSI=%.4f). Retraining %s (threshold=0.01).',
                        CASE drift_level WHEN 'high' THEN 'High' ELSE 'Moderate' END, psi,
                        CASE WHEN should_retrain THEN 'triggered' ELSE 'not triggered' END) END AS reason
FROM decided"""


SNAPSHOT = f"""WITH ref AS (SELECT o_totalprice AS price, ln(1 + o_totalprice) AS x FROM orders WHERE {EARLY}),
e AS (SELECT list_sort(list_distinct(quantile_cont(x, {grid(10)}))) AS ed,
             quantile_cont(price, {grid(10)}) AS raw FROM ref),
rb AS (SELECT {bucket('x', 'ed')} AS b, count(*) AS n FROM ref, e GROUP BY ALL),
shares AS (SELECT b, coalesce(n, 0) / (SELECT count(*) FROM ref) AS share
           FROM (SELECT unnest(range(len(ed) - 1)) AS b FROM e) LEFT JOIN rb USING (b)),
long AS (
  SELECT 'row_count' AS field, 0 AS position, count(*)::DOUBLE AS value FROM ref
  UNION ALL SELECT 'bins', 0, 10 UNION ALL SELECT 'price_median', 0, median(price) FROM ref
  UNION ALL SELECT 'price_mean', 0, avg(price) FROM ref
  UNION ALL SELECT 'price_std', 0, stddev_samp(price) FROM ref
  UNION ALL SELECT 'price_log_bin_edges', unnest(range(len(ed))), unnest(ed) FROM e
  UNION ALL SELECT 'price_raw_quantiles', unnest(range(len(raw))), unnest(raw) FROM e
  UNION ALL SELECT 'price_log_ref_pct', b, share FROM shares
)
SELECT (SELECT strftime(max(o_orderdate), '%Y-%m-%d') FROM orders WHERE {EARLY}) AS snapshot_date,
       field, position::INTEGER AS position, round(value, 6) AS value FROM long"""


def higher(x: str, share: str, source: str) -> str:
    """The upper neighbour of a quantile: the value at 0-based rank ceil((n - 1) q)."""
    return (
        f"(SELECT v[(ceil((len(v) - 1) * {share}::DOUBLE))::BIGINT + 1] "
        f"FROM (SELECT list_sort(list({x})) AS v FROM {source}))"
    )


CALIBRATED = f"""{PAIRS},
cut AS (SELECT quantile_cont(p, [0.2::DOUBLE, 0.4::DOUBLE, 0.6::DOUBLE, 0.8::DOUBLE]) AS ed,
               count(*) AS n FROM errors),
placed AS (SELECT error, len(list_filter(ed, lambda e: e <= p)) AS segment FROM errors, cut),
overall AS (SELECT {higher('error', '0.95', 'errors')} AS overall),
each_one AS (SELECT segment, count(*) AS n, list_sort(list(error)) AS v FROM placed GROUP BY segment),
calibrated AS (
  SELECT s.segment, ed[s.segment + 1] AS upper_edge, overall, cut.n AS calibration_size,
         CASE WHEN coalesce(each_one.n, 0) >= 10
              THEN v[(ceil((each_one.n - 1) * 0.95::DOUBLE))::BIGINT + 1] ELSE overall END AS quantile
  FROM (SELECT unnest(range(5)) AS segment) s CROSS JOIN cut CROSS JOIN overall LEFT JOIN each_one USING (segment)
)"""

CALIBRATED_ROWS = f"""WITH {CALIBRATED}
SELECT segment::INTEGER AS segment, CASE WHEN segment < 4 THEN round(upper_edge, 4) END AS upper_edge,
       round(quantile, 9) AS quantile, round(overall, 9) AS overall, calibration_size FROM calibrated"""

LEGACY = f"""{PAIRS}, bounded AS (
  SELECT property_id, prediction, greatest(0.0::DOUBLE, p * (1.0::DOUBLE - q)) AS lower_bound,
         p * (1.0::DOUBLE + q) AS upper_bound
  FROM (SELECT *, CASE WHEN p < 150000 THEN 0.45::DOUBLE WHEN p < 320000 THEN 0.3::DOUBLE
                       ELSE 0.2::DOUBLE END AS q FROM errors)
)"""

NUMERIC_STATS = ", ".join(f"median({c}) AS m_{c}" for c in NUMERIC_FEATURES)
FILLED = f"""{LISTINGS}, medians AS (SELECT {NUMERIC_STATS} FROM listings),
filled AS (SELECT property_id, property_type, vegas_district,
  {", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in NUMERIC_FEATURES)} FROM listings, medians),
spread AS (SELECT {", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}" for c in NUMERIC_FEATURES)} FROM filled)"""
SCALED = ", ".join(f"round(({c} - a_{c}) / s_{c}, 6) AS {c}" for c in NUMERIC_FEATURES)

TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
NATIONS = [f"NATION_{i}" for i in range(25)]


def encoded(column: str, values: list[str]) -> str:
    return ", ".join(
        f"CASE WHEN {column} = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"{column}_{v}\"" for v in values
    )


def most_frequent(column: str, source: str) -> str:
    return (
        f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


RIDGE = f"""fit AS (
  SELECT *, sum((x - mx) * (y - my)) OVER () / (sum((x - mx) * (x - mx)) OVER () + {q.RIDGE_ALPHA}::DOUBLE) AS slope
  FROM (SELECT *, avg(x) OVER () AS mx, avg(y) OVER () AS my
        FROM (SELECT f.property_id, (f.living_area - a_living_area) / s_living_area AS x, ln(1 + l.price) AS y
              FROM filled f JOIN listings l USING (property_id), spread))
), coefficients AS (SELECT any_value(slope) AS slope, any_value(mx) AS mx, any_value(my) AS my FROM fit)"""

ERRORS = """list_filter([
  CASE WHEN bedrooms IS NULL THEN 'bedrooms: required' END,
  CASE WHEN bedrooms <> floor(bedrooms) THEN 'bedrooms: must be a whole number' END,
  CASE WHEN bedrooms < 0 THEN 'bedrooms: must be >= 0' END,
  CASE WHEN bedrooms > 20 THEN 'bedrooms: must be <= 20' END,
  CASE WHEN bathrooms IS NULL THEN 'bathrooms: required' END,
  CASE WHEN bathrooms < 0 THEN 'bathrooms: must be >= 0' END,
  CASE WHEN bathrooms > 20 THEN 'bathrooms: must be <= 20' END,
  CASE WHEN livingarea IS NULL THEN 'livingarea: required' END,
  CASE WHEN livingarea <= 0 THEN 'livingarea: must be > 0' END,
  CASE WHEN latitude < -90 THEN 'latitude: must be >= -90' END,
  CASE WHEN latitude > 90 THEN 'latitude: must be <= 90' END,
  CASE WHEN longitude < -180 THEN 'longitude: must be >= -180' END,
  CASE WHEN longitude > 180 THEN 'longitude: must be <= 180' END,
  CASE WHEN propertytype IS NULL OR propertytype = '' THEN 'propertytype: required' END
], lambda e: e IS NOT NULL)"""

FEATURES = "vegas_district, latitude, longitude, property_type, price, bedrooms, bathrooms, living_area, normalized_lot_area_value"
KEPT = "price BETWEEN 100000 AND 5000000 AND living_area >= 20"
MD5 = "md5('42:' || property_id::VARCHAR)"
PLACED = f"""{LISTINGS}, {CENTROIDS}, placed AS (
  SELECT property_id, vegas_district, coalesce(latitude, c_lat) AS latitude, coalesce(longitude, c_lon) AS longitude
  FROM listings LEFT JOIN centroids ON vegas_district = n_name
)"""
QUANTILE_ROWS = "unnest(range(len(v)))::INTEGER AS step, round(unnest(v), {digits}) AS value"


def promoted(grown: str, targets: str) -> str:
    return f"""SELECT g.model_name, g.version, g.run_id,
       CASE WHEN g.version = t.version THEN 'Production'
            WHEN t.version IS NOT NULL AND g.stage = 'Production' THEN 'Archived' ELSE g.stage END AS stage
FROM {grown} g LEFT JOIN {targets} t USING (model_name)"""


PROMOTED = f"""WITH {VERSIONS}, targets AS (
  SELECT model_name, max(version) AS version FROM versions WHERE stage = 'Staging' GROUP BY model_name)
{promoted('versions', 'targets')}"""

STUMP = f"""WITH {LISTINGS}, t AS (SELECT property_id, bedrooms, price FROM listings WHERE bedrooms IS NOT NULL AND price IS NOT NULL),
cuts AS (SELECT c.bedrooms AS cut, avg(price) FILTER (WHERE t.bedrooms <= c.bedrooms) AS low, avg(price) FILTER (WHERE t.bedrooms > c.bedrooms) AS high,
                count(*) FILTER (WHERE t.bedrooms <= c.bedrooms) AS n_low, count(*) FILTER (WHERE t.bedrooms > c.bedrooms) AS n_high
         FROM t, (SELECT DISTINCT bedrooms FROM t) c GROUP BY c.bedrooms),
best AS (SELECT * FROM cuts WHERE n_high > 0 ORDER BY n_low * low * low + n_high * high * high DESC LIMIT 1)
SELECT property_id, round(CASE WHEN bedrooms <= cut THEN low ELSE high END, 3) AS prediction FROM t, best"""

#: Every tree of the forest is this stump, so both bounds are its prediction.
STUMP_BOUNDS = f"SELECT property_id, prediction, prediction AS lower_bound, prediction AS upper_bound FROM ({STUMP})"


def _leafwise() -> str:
    """A tree grown by three best splits, each over all leaves, columns and values at once."""
    steps = ["""t AS (
  SELECT property_id, bedrooms, bathrooms, property_type, price - avg(price) OVER () AS r, avg(price) OVER () AS mean FROM listings
  WHERE bedrooms IS NOT NULL AND bathrooms IS NOT NULL AND property_type IS NOT NULL AND price IS NOT NULL
), kinds AS (SELECT property_type AS kind, 1 + row_number() OVER (ORDER BY property_type) AS f FROM (SELECT DISTINCT property_type FROM t)
), l AS (
  SELECT property_id, 0 AS f, bedrooms AS v FROM t UNION ALL SELECT property_id, 1, bathrooms FROM t
  UNION ALL SELECT property_id, f, (property_type = kind)::INT::DOUBLE FROM t, kinds
), a0 AS (SELECT property_id, r, 0 AS leaf FROM t)"""]
    for k in (1, 2, 3):
        steps.append(f"""s{k} AS (SELECT leaf, f, v, count(*) AS n, sum(r) AS g FROM a{k - 1} JOIN l USING (property_id) GROUP BY ALL),
w{k} AS (SELECT leaf, f, v AS cut, sum(n) OVER run AS nl, sum(g) OVER run AS gl, sum(n) OVER whole AS nn, sum(g) OVER whole AS gg FROM s{k}
  WINDOW run AS (PARTITION BY leaf, f ORDER BY v), whole AS (PARTITION BY leaf, f)),
b{k} AS (SELECT *, gl * gl / (nl + 5) + (gg - gl) * (gg - gl) / (nn - nl + 5) - gg * gg / (nn + 5) AS gain FROM w{k}
  WHERE nl >= 20 AND nn - nl >= 20 ORDER BY gain DESC, f, cut LIMIT 1),
a{k} AS (SELECT a.property_id, r, CASE WHEN a.leaf = b.leaf AND l.v > b.cut THEN {k} ELSE a.leaf END AS leaf
  FROM a{k - 1} a, b{k} b, l WHERE l.property_id = a.property_id AND l.f = b.f)""")
    return f"WITH {LISTINGS}, " + ",\n".join(steps)


LEAFWISE = _leafwise()
LEAFWISE_TREE = f"""{LEAFWISE}
SELECT property_id, round(mean + g, 3) AS prediction
FROM (SELECT property_id, sum(r) OVER (PARTITION BY leaf) / (count(*) OVER (PARTITION BY leaf) + 5) AS g FROM a3) JOIN t USING (property_id)"""
LEAFWISE_IMPORTANCE = f"""{LEAFWISE}, gains AS (SELECT f, gain FROM b1 UNION ALL SELECT f, gain FROM b2 UNION ALL SELECT f, gain FROM b3),
named AS (SELECT 0 AS f, 'bedrooms' AS feature UNION ALL SELECT 1, 'bathrooms' UNION ALL SELECT f, 'property_type_' || kind FROM kinds)
SELECT feature, round(coalesce(sum(gain), 0) / (SELECT sum(gain) FROM gains), 9) AS importance
FROM named LEFT JOIN gains USING (f) GROUP BY feature ORDER BY importance DESC, feature LIMIT 5"""

SEVERAL = f"""WITH {VERSIONS}, after AS (
  SELECT g.model_name, p.model_name IS NOT NULL OR g.passed AS held,
         CASE WHEN g.passed THEN g.candidate_metric ELSE g.production_metric END AS production_metric
  FROM gated g LEFT JOIN production p USING (model_name)
), second AS (
  SELECT 'model_' || c_custkey AS model_name, 'second_' || c_custkey AS run_id,
         CASE WHEN c_custkey % 17 <> 0 THEN (c_custkey * 7 % 32) / 32.0::DOUBLE END AS candidate_metric FROM customer
), regated AS (
  SELECT s.model_name, s.run_id, s.candidate_metric, a.production_metric,
         NOT a.held OR (s.candidate_metric IS NOT NULL AND coalesce(s.candidate_metric - a.production_metric > 0.02::DOUBLE, true)) AS passed,
         CASE WHEN NOT a.held THEN 'no production version' WHEN s.candidate_metric IS NULL THEN 'candidate lacks the metric'
              WHEN a.production_metric IS NULL THEN 'production lacks the metric'
              WHEN s.candidate_metric - a.production_metric > 0.02::DOUBLE THEN 'gain above the threshold'
              ELSE 'gain not above the threshold' END AS reason
  FROM second s JOIN after a USING (model_name)
), verdicts AS (SELECT * FROM gated UNION ALL SELECT * FROM regated
), registered AS (
  SELECT v.model_name, v.run_id, coalesce(last.version, 0) + row_number() OVER (
           PARTITION BY v.model_name ORDER BY v.run_id LIKE 'second%') AS version
  FROM verdicts v LEFT JOIN last USING (model_name) WHERE passed
)"""

PRICE_PSI = f"WITH {early_late('ln(1 + o_totalprice)')} SELECT * FROM scored"

_edges = "[" + ", ".join(f"{e}::DOUBLE" for e in q.HISTOGRAM_EDGES) + "]"

ORACLE: dict[str, str] = {
    "scan_priced": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice IS NOT NULL",
    "scan_positive_priced": """SELECT * FROM (
  SELECT o_orderkey AS property_id,
         CASE WHEN o_orderkey % 41 = 0 THEN NULL WHEN o_orderkey % 43 = 0 THEN 'NaN'::DOUBLE
              WHEN o_orderkey % 47 = 0 THEN -o_totalprice ELSE o_totalprice END AS price FROM orders)
WHERE price IS NOT NULL AND NOT isnan(price) AND price > 0""",
    "sql_with_params": "SELECT o_orderkey, o_totalprice FROM orders "
    "WHERE o_totalprice >= 250000 AND o_orderpriority = '2-HIGH'",
    "csv_roundtrip": f"WITH {PRICED} SELECT * FROM priced",
    "latest_per_key": """SELECT o_custkey, o_orderdate::DATE AS o_orderdate, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY orders.o_orderdate DESC, o_orderkey DESC) = 1""",
    "drop_columns": f"WITH {LISTINGS} SELECT {FEATURES} FROM listings",
    "cast_numeric": f"WITH {LISTINGS} SELECT property_id, {', '.join(NUMERIC_FEATURES)} FROM listings",
    "exclude_types": f"""WITH {PRICED} SELECT property_id, property_type FROM priced
WHERE property_type IS NULL OR property_type <> '4-NOT SPECIFIED'""",
    "outlier_filter": f"WITH {LISTINGS} SELECT property_id, price, living_area FROM listings WHERE {KEPT}",
    "select_contract": f"WITH {LISTINGS} SELECT {FEATURES} FROM listings",
    "clean_rows": f"""WITH {LISTINGS} SELECT property_id, {FEATURES} FROM listings
WHERE property_type IS NULL OR property_type <> '4-NOT SPECIFIED'""",
    "alias_rename": f"""WITH {REQUESTS} SELECT property_id, bedrooms, bathrooms,
  coalesce(livingarea, living_area) AS living_area, latitude, longitude, normalized_lot_area_value,
  vegas_district, propertytype AS property_type FROM requests""",
    "validate_rows": f"""WITH {REQUESTS}
SELECT property_id, array_to_string({ERRORS}, '; ') AS errors FROM requests""",
    "reject_summary": f"""WITH {REQUESTS}
SELECT error, count(*) AS rows FROM (SELECT unnest({ERRORS}) AS error FROM requests) GROUP BY error""",
    "fill_optional": f"""WITH {REQUESTS} SELECT property_id,
  coalesce(normalized_lot_area_value, 5000.0::DOUBLE) AS normalized_lot_area_value FROM requests""",
    "unseen_categories": f"""WITH {LISTINGS}
SELECT 'property_type' AS feature, property_type AS value, count(*) AS rows FROM listings
WHERE property_type NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY ALL
UNION ALL SELECT 'vegas_district', vegas_district, count(*) FROM listings
WHERE replace(vegas_district, 'NATION_', '')::INTEGER >= 12 GROUP BY ALL""",
    "dedup_rows": "SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag FROM lineitem",
    "hash_split": f"""WITH {PRICED} SELECT property_id,
  CASE WHEN concat('0x', substr({MD5}, 1, 8))::UBIGINT < 858993459 THEN 'test' ELSE 'train' END AS side FROM priced""",
    "exact_split": f"""WITH {PRICED} SELECT property_id,
  CASE WHEN row_number() OVER (ORDER BY {MD5}) <= ceil((SELECT count(*) FROM priced) * 0.2::DOUBLE)
       THEN 'test' ELSE 'train' END AS side FROM priced""",
    "centroid_backfill": f"WITH {PLACED} SELECT * FROM placed",
    "missing_location": f"WITH {PLACED} SELECT * FROM placed WHERE latitude IS NULL OR longitude IS NULL",
    "price_summary": """SELECT strftime(max(o_orderdate), '%Y-%m-%d') AS snapshot_date, count(*) AS row_count,
  round(avg(o_totalprice), 4) AS price_mean, round(stddev_samp(o_totalprice), 4) AS price_std,
  round(median(o_totalprice), 4) AS price_median FROM orders""",
    "quantiles": f"""SELECT {QUANTILE_ROWS.format(digits=4)}
FROM (SELECT quantile_cont(o_totalprice, {grid(10)}) AS v FROM orders)""",
    "quantiles_by_cuts": f"""SELECT {QUANTILE_ROWS.format(digits=4)}
FROM (SELECT quantile_cont(l_extendedprice, {grid(20)}) AS v FROM lineitem)""",
    "histogram": f"""WITH found AS (SELECT {bucket('o_totalprice', _edges)} AS b, count(*) AS n FROM orders
  WHERE o_totalprice BETWEEN {q.HISTOGRAM_EDGES[0]} AND {q.HISTOGRAM_EDGES[-1]} GROUP BY ALL)
SELECT s.b::INTEGER AS bucket, coalesce(n, 0) AS rows
FROM (SELECT unnest(range({len(q.HISTOGRAM_EDGES) - 1})) AS b) s LEFT JOIN found USING (b)""",
    "order_stat_higher": f"""WITH {PAIRS} SELECT {QUANTILE_ROWS.format(digits=9)} FROM (SELECT [
  {higher('error', '0.05', 'errors')}, {higher('error', '0.5', 'errors')}, {higher('error', '0.95', 'errors')}] AS v)""",
    "order_stat_by_customer": """WITH r AS (
  SELECT o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice) - 1 AS place,
         (count(*) OVER (PARTITION BY o_custkey) - 1)::DOUBLE AS last FROM orders)
SELECT o_custkey, count(*) AS orders_held,
  round(max(o_totalprice) FILTER (WHERE place = ceil(last * 0.05::DOUBLE)), 4) AS value_0,
  round(max(o_totalprice) FILTER (WHERE place = ceil(last * 0.5::DOUBLE)), 4) AS value_1,
  round(max(o_totalprice) FILTER (WHERE place = ceil(last * 0.95::DOUBLE)), 4) AS value_2 FROM r GROUP BY o_custkey""",
    "order_stat_by_status_by_cuts": """SELECT o_orderstatus, count(*) AS orders_held,
  round(quantile_cont(o_totalprice, 0.1), 4) AS value_0, round(quantile_cont(o_totalprice, 0.5), 4) AS value_1,
  round(quantile_cont(o_totalprice, 0.9), 4) AS value_2 FROM orders GROUP BY o_orderstatus""",
    "regression_metrics": f"""WITH {PAIRS} SELECT
  round(1 - sum((actual - prediction) * (actual - prediction))
        / (SELECT sum((actual - m) * (actual - m)) FROM pairs, (SELECT avg(actual) AS m FROM pairs)), 9) AS r2,
  round(sqrt(avg((actual - prediction) * (actual - prediction))), 3) AS rmse,
  round(avg(abs(actual - prediction)), 3) AS mae,
  round(avg((actual - prediction) * (actual - prediction)), 3) AS mse FROM pairs""",
    "cheap_segment_mae": f"""WITH {PAIRS}, c AS (SELECT quantile_cont(actual, 0.25) AS cut FROM pairs)
SELECT round(avg(abs(actual - prediction)) FILTER (WHERE actual <= cut), 4) AS cheap_segment_mae,
       round(any_value(cut), 4) AS cheap_segment_cutoff_p25 FROM pairs, c""",
    "psi": f"WITH {early_late('o_totalprice')} SELECT * FROM scored",
    "price_psi": PRICE_PSI,
    "price_psi_by_cuts": PRICE_PSI,
    "drift_snapshot": SNAPSHOT,
    "snapshot_roundtrip": SNAPSHOT,
    **dict.fromkeys(
        ("psi_vs_snapshot", "psi_of_batches"),
        f"""WITH {early_late('ln(1 + o_totalprice)', True)}
SELECT psi, current_rows FROM scored""",
    ),
    "drift_verdict": verdict(f" * {q.RAISED}::DOUBLE"),
    "refresh_job": verdict(""),
    "verdict_no_reference": f"""SELECT false AS should_retrain, NULL::DOUBLE AS psi, 0.01::DOUBLE AS psi_threshold,
       'no_reference' AS drift_level, count(*) AS current_row_count, NULL::BIGINT AS reference_row_count,
       round(median(o_totalprice), 4) AS current_price_median, NULL::DOUBLE AS reference_price_median,
       NULL::VARCHAR AS reference_snapshot_date, strftime(max(o_orderdate), '%Y-%m-%d') AS current_snapshot_date,
       '{drift.FIRST_RUN}' AS reason FROM orders WHERE {LATE}""",
    "verdict_unknown": f"""SELECT false AS should_retrain, NULL::DOUBLE AS psi, 0.01::DOUBLE AS psi_threshold,
       'unknown' AS drift_level, count(*) AS current_row_count, (SELECT count(*) FROM orders WHERE {EARLY}) AS reference_row_count,
       round(median(o_totalprice), 4) AS current_price_median, 100.0::DOUBLE AS reference_price_median,
       (SELECT strftime(max(o_orderdate), '%Y-%m-%d') FROM orders WHERE {EARLY}) AS reference_snapshot_date,
       strftime(max(o_orderdate), '%Y-%m-%d') AS current_snapshot_date,
       '{drift.NOT_COMPUTED}' AS reason FROM orders WHERE {LATE}""",
    "psi_guards": f"""SELECT unnest(['constant', 'few']) AS case_name, NULL::DOUBLE AS psi, count(*) AS reference_rows
FROM orders WHERE {EARLY}""",
    "snapshot_replaced": SNAPSHOT,
    "impute_median": f"""WITH {FILLED} SELECT property_id,
  {", ".join(f"round({c}, 6) AS {c}" for c in NUMERIC_FEATURES)} FROM filled""",
    "standard_scale": f"WITH {FILLED} SELECT property_id, {SCALED} FROM filled, spread",
    "impute_mode": f"""WITH {PRICED} SELECT property_id,
  coalesce(property_type, {most_frequent('property_type', 'priced')}) AS property_type FROM priced""",
    "one_hot": f"WITH {PRICED} SELECT property_id, {encoded('property_type', TYPES)} FROM priced",
    "one_hot_unseen": f"WITH {PRICED} SELECT property_id, {encoded('property_type', q.ENCODED_TYPES)} FROM priced",
    "preprocess": f"""WITH {FILLED}, complete AS (
  SELECT * REPLACE (coalesce(property_type, {most_frequent('property_type', 'listings')}) AS property_type,
                    coalesce(vegas_district, {most_frequent('vegas_district', 'listings')}) AS vegas_district)
  FROM filled)
SELECT property_id, {SCALED}, {encoded('property_type', TYPES)}, {encoded('vegas_district', NATIONS)}
FROM complete, spread""",
    "target_transform": """SELECT o_orderkey AS property_id, round(ln(1 + o_totalprice), 9) AS log_price,
  round(exp(ln(1 + o_totalprice)) - 1, 4) AS price FROM orders""",
    "calibrate_interval": CALIBRATED_ROWS,
    "calibrate_interval_by_cuts": CALIBRATED_ROWS,
    "apply_interval": f"""WITH {CALIBRATED}, sides AS (
  SELECT list(quantile ORDER BY segment) AS qs, any_value(cut.ed) AS ed FROM calibrated, cut)
SELECT property_id, prediction, greatest(0.0::DOUBLE, p * (1.0::DOUBLE - q)) AS lower_bound,
       p * (1.0::DOUBLE + q) AS upper_bound
FROM (SELECT *, qs[len(list_filter(ed, lambda e: e <= p)) + 1] AS q FROM errors, sides)""",
    "apply_interval_legacy": f"WITH {LEGACY} SELECT * FROM bounded",
    "interval_margin": f"""WITH {LEGACY} SELECT property_id,
  (upper_bound - lower_bound) / 2 AS margin,
  (upper_bound - lower_bound) / 2 / nullif(prediction, 0) * 100 AS margin_pct,
  95.0::DOUBLE AS confidence_level FROM bounded""",
    "csv_line_breaks": f"""WITH {PRICED} SELECT property_id, price, '12 "Main", St' || chr(10) || 'Apt ' || property_id AS address FROM priced""",
    "validate_text_rows": f"""WITH {REQUESTS}, texts AS (
  SELECT property_id, propertytype,
         CASE WHEN property_id % 5 = 0 THEN 'abc' ELSE bedrooms::DECIMAL(12,2)::VARCHAR END AS bedrooms,
         CASE WHEN property_id % 7 = 0 THEN '99' WHEN property_id % 11 = 0 THEN '' ELSE bathrooms::DECIMAL(12,2)::VARCHAR END AS bathrooms,
         CASE WHEN property_id % 13 = 0 THEN '-5' ELSE livingarea::DECIMAL(12,2)::VARCHAR END AS livingarea FROM requests),
checked AS (SELECT *, try_cast(bedrooms AS DOUBLE) AS b, try_cast(bathrooms AS DOUBLE) AS t, try_cast(livingarea AS DOUBLE) AS a FROM texts)
SELECT property_id, array_to_string(list_filter([
  CASE WHEN coalesce(bedrooms, '') = '' THEN 'bedrooms: required' END,
  CASE WHEN bedrooms <> '' AND b IS NULL THEN 'bedrooms: must be a number' END,
  CASE WHEN b <> floor(b) THEN 'bedrooms: must be a whole number' END,
  CASE WHEN b < 0 THEN 'bedrooms: must be >= 0' END, CASE WHEN b > 20 THEN 'bedrooms: must be <= 20' END,
  CASE WHEN coalesce(bathrooms, '') = '' THEN 'bathrooms: required' END,
  CASE WHEN bathrooms <> '' AND t IS NULL THEN 'bathrooms: must be a number' END,
  CASE WHEN t < 0 THEN 'bathrooms: must be >= 0' END, CASE WHEN t > 20 THEN 'bathrooms: must be <= 20' END,
  CASE WHEN coalesce(livingarea, '') = '' THEN 'livingarea: required' END,
  CASE WHEN livingarea <> '' AND a IS NULL THEN 'livingarea: must be a number' END,
  CASE WHEN a <= 0 THEN 'livingarea: must be > 0' END,
  CASE WHEN coalesce(propertytype, '') = '' THEN 'propertytype: required' END], lambda e: e IS NOT NULL), '; ') AS errors FROM checked""",
    "regression_metrics_missing": f"""WITH {PAIRS}, complete AS (SELECT * FROM pairs WHERE property_id % 5 <> 0 AND property_id % 3 <> 0) SELECT
  round(1 - sum((actual - prediction) * (actual - prediction))
        / (SELECT sum((actual - m) * (actual - m)) FROM complete, (SELECT avg(actual) AS m FROM complete)), 9) AS r2,
  round(sqrt(avg((actual - prediction) * (actual - prediction))), 3) AS rmse,
  round(avg(abs(actual - prediction)), 3) AS mae,
  round(avg((actual - prediction) * (actual - prediction)), 3) AS mse FROM complete""",
    "one_hot_index": """WITH o AS (SELECT o_orderkey AS property_id, o_custkey::VARCHAR AS customer FROM orders)
SELECT property_id, dense_rank() OVER (ORDER BY customer) - 1 AS index FROM o""",
    "one_hot_index_prefixed": """WITH o AS (SELECT o_orderkey AS property_id, printf('Customer#%09d', o_custkey) AS customer FROM orders)
SELECT property_id, dense_rank() OVER (ORDER BY customer) - 1 AS index FROM o""",
    "scale_constant": f"""WITH {PRICED} SELECT property_id,
  CASE WHEN property_id % 3 <> 0 THEN round((property_id % 5)::DOUBLE, 6) ELSE 0.0::DOUBLE END AS latitude FROM priced""",
    "forest_stump": STUMP,
    "boosted_stump": STUMP,
    "leafwise_tree": LEAFWISE_TREE,
    "leafwise_importance": LEAFWISE_IMPORTANCE,
    "forest_interval_stumps": STUMP_BOUNDS,
    "forest_interval_stumps_joined": STUMP_BOUNDS,
    "flat_bounds": f"""WITH {PRICED} SELECT property_id, price AS prediction, price AS lower_bound, price AS upper_bound FROM priced""",
    "train_job_metadata": f"""WITH {LISTINGS}, kept AS (
  SELECT * FROM listings WHERE (property_type IS NULL OR property_type <> '4-NOT SPECIFIED') AND {KEPT}
), sided AS (
  SELECT *, row_number() OVER (ORDER BY {MD5}) <= ceil((SELECT count(*) FROM kept) * 0.2::DOUBLE) AS test FROM kept
)
SELECT 'ridge' AS model_key, 'log1p' AS target_transform, count(*) FILTER (NOT test) AS train_size, count(*) FILTER (test) AS test_size,
  count(*) FILTER (test) AS calibration_size, round(quantile_cont(price, 0.25::DOUBLE) FILTER (test), 4) AS cutoff,
  {len(NUMERIC_FEATURES)} + count(DISTINCT property_type) FILTER (NOT test) + count(DISTINCT vegas_district) FILTER (NOT test) AS feature_count
FROM sided""",
    "stump_importance": "SELECT 'bedrooms' AS feature, 1.0::DOUBLE AS importance",
    "train_ridge_one_feature": f"""WITH {FILLED}, {RIDGE}
SELECT property_id, round(exp(my + slope * (x - mx)) - 1, 2) AS prediction FROM fit""",
    "score_table": f"""WITH {FILLED}, {RIDGE}, {CENTROIDS}, {REQUESTS.split('), ', 2)[2]},
scored AS (
  SELECT r.*, exp(my + slope * ((coalesce(r.livingarea, r.living_area, m_living_area) - a_living_area) / s_living_area - mx)) - 1
           AS prediction
  FROM requests r LEFT JOIN centroids ON r.vegas_district = n_name, medians, spread, coefficients
  WHERE coalesce(r.latitude, c_lat) IS NOT NULL AND coalesce(r.longitude, c_lon) IS NOT NULL
), sized AS (
  SELECT *, CASE WHEN prediction < 200000 THEN 0.5::DOUBLE WHEN prediction < 202000 THEN 0.4::DOUBLE
    WHEN prediction < 204000 THEN 0.3::DOUBLE WHEN prediction < 206000 THEN 0.2::DOUBLE ELSE 0.1::DOUBLE END AS q
  FROM scored)
SELECT property_id, livingarea, living_area, latitude, round(prediction, 2) AS prediction,
       round(prediction * (1 - q), 2) AS lower_bound, round(prediction * (1 + q), 2) AS upper_bound FROM sized""",
    "list_versions": f"WITH {VERSIONS} SELECT * FROM versions",
    "resolve_version": f"""WITH {VERSIONS} SELECT model_name, max(version) AS version FROM versions
WHERE stage = 'Production' GROUP BY model_name""",
    "production_metric": f"WITH {VERSIONS} SELECT * FROM production",
    "promotion_gate": f"WITH {VERSIONS} SELECT * FROM gated",
    "gate_one_model": """WITH RECURSIVE c AS (
  SELECT o_orderkey AS position, 'run_' || o_orderkey AS run_id, (o_orderkey * 7919) % 100003 / 100003.0::DOUBLE AS metric FROM orders),
passes AS (
  SELECT min(position) AS position, arg_min(metric, position) AS metric FROM c
  UNION ALL
  SELECT min(c.position), arg_min(c.metric, c.position) FROM c, passes p
  WHERE c.position > p.position AND c.metric - p.metric > 0.02::DOUBLE HAVING count(*) > 0),
met AS (
  SELECT c.*, p.metric AS held FROM c ASOF LEFT JOIN passes p ON c.position > p.position)
SELECT 'price' AS model_name, run_id, metric AS candidate_metric, held AS production_metric,
  held IS NULL OR metric - held > 0.02::DOUBLE AS passed,
  CASE WHEN held IS NULL THEN 'no production version' WHEN metric - held > 0.02::DOUBLE THEN 'gain above the threshold'
       ELSE 'gain not above the threshold' END AS reason FROM met""",
    "register_versions": f"""WITH {VERSIONS} SELECT g.model_name, coalesce(last.version, 0) + 1 AS version, g.run_id,
  'Staging' AS stage FROM gated g LEFT JOIN last USING (model_name) WHERE passed""",
    "promote_version": PROMOTED,
    "promote_missing_target": f"""WITH {VERSIONS}, targets AS (
  SELECT model_name, version FROM (SELECT model_name, max(version) AS version FROM versions WHERE stage = 'Staging' GROUP BY model_name)
  WHERE version % 2 <> 0)
{promoted('versions', 'targets')}""",
    "promote_several_candidates": f"""{SEVERAL} SELECT v.*, r.version FROM verdicts v LEFT JOIN registered r USING (model_name, run_id)""",
    "promote_several_stages": f"""{SEVERAL}, targets AS (SELECT model_name, max(version) AS version FROM registered GROUP BY model_name),
grown AS (SELECT * FROM versions UNION ALL SELECT model_name, version, run_id, 'Production' FROM registered)
{promoted('grown', 'targets')}""",
    "promote_job": f"""WITH {VERSIONS}, registered AS (
  SELECT g.model_name, coalesce(last.version, 0) + 1 AS version, g.run_id, NULL AS stage
  FROM gated g LEFT JOIN last USING (model_name) WHERE passed),
grown AS (SELECT * FROM versions UNION ALL SELECT * FROM registered)
{promoted('grown', 'registered')}""",
}
ORACLE["score_job_csv"] = ORACLE["score_table"].replace("coalesce(r.livingarea, r.living_area, m_living_area)", "coalesce(r.livingarea, m_living_area)").replace(
    "SELECT property_id, livingarea, living_area, latitude, round", "SELECT property_id, round"
)
ORACLE["promote_in_store"] = ORACLE["promote_job"]
ORACLE["model_roundtrip_one_feature"] = ORACLE["train_ridge_one_feature"]
