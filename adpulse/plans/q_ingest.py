"""Daily-path queries: sources/sinks, flattening, casts, stages 1-3, places,
windows, search list and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from adpulse import fixtures as fx
from adpulse.functions import scalars as sc
from adpulse.operators import clean, geo, ingest, search
from adpulse.operators.features import add_features, add_time_parts
from adpulse.operators.stages import clean_and_locate
from adpulse.plans.catalog import register
from adpulse.schemas import API_RESULT_SCHEMA, GOV_RESULT_SCHEMA, RAW_FIELDS, RESULT_LIST_SCHEMA
from adpulse.sources import readers, sinks


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    """Timestamps as wall-clock UTC values (the oracle's TIMESTAMP)."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


_EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _events_by_day(spark, sf_dir) -> tuple[DataFrame, str]:
    ev = fx.table(spark, sf_dir, "events").select(*_EVENT_COLS)
    ev = ev.withColumns({"year": F.year("ts"), "month": F.month("ts"), "day": F.dayofmonth("ts")})
    path = sinks.scratch_path(spark, "events-by-day")
    sinks.write_partitions(ev, path, ["year", "month", "day"])
    return ev, path


_EV_SQL = ("SELECT event_id, ts, user_id, event_type, value, props, CAST(year(ts) AS INTEGER) AS year, "
           "CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day FROM events")


@register("scan_parquet", f"SELECT * FROM ({_EV_SQL}) WHERE year = 2024 AND month = 1 AND day = 15")
def scan_parquet(spark, sf_dir):
    """One day of a year/month/day-partitioned dataset (partition pruning)."""
    ev, path = _events_by_day(spark, sf_dir)
    return readers.read_day(spark, path, "2024-01-15").select(*ev.columns)


@register("scan_month", f"SELECT * FROM ({_EV_SQL}) WHERE year = 2024 AND month = 1")
def scan_month(spark, sf_dir):
    """S3: all days of one month."""
    ev, path = _events_by_day(spark, sf_dir)
    return readers.read_month(spark, path, 2024, 1).select(*ev.columns)


@register("sink_roundtrip", _EV_SQL.replace(
    "value, props", "CASE WHEN day(ts) = 15 THEN value * 2 ELSE value END AS value, props"))
def sink_roundtrip(spark, sf_dir):
    """Partitioned write, then one day rewritten: dynamic overwrite
    replaces that day only."""
    ev, path = _events_by_day(spark, sf_dir)
    day15 = ev.filter(F.col("day") == 15).withColumn("value", F.col("value") * 2)
    sinks.write_partitions(day15, path, ["year", "month", "day"])
    return spark.read.schema(ev.schema).parquet(path).select(*ev.columns)


@register("rerun_smaller_month", f"SELECT * FROM ({_EV_SQL}) WHERE year = 2024 AND month = 1 AND day <> 15")
def rerun_smaller_month(spark, sf_dir):
    """A month written again without one of its days: that day goes."""
    ev, path = _events_by_day(spark, sf_dir)
    january = ev.filter("year = 2024 and month = 1 and day <> 15").drop("year", "month")
    sinks.replace_scope(january, path, {"year": 2024, "month": 1}, ["day"])
    return readers.read_month(spark, path, 2024, 1, january.schema).select(*ev.columns)


@register("rerun_empty_day", f"SELECT * FROM ({_EV_SQL}) WHERE NOT (year = 2024 AND month = 1 AND day = 15)")
def rerun_empty_day(spark, sf_dir):
    """A day written again without rows: its earlier rows go, others stay."""
    ev, path = _events_by_day(spark, sf_dir)
    day = {"year": 2024, "month": 1, "day": 15}
    sinks.replace_scope(ev.filter(F.lit(False)).drop(*day), path, day)
    return spark.read.schema(ev.schema).parquet(path).select(*ev.columns)


_SWAP_SQL = (f"SELECT id, COALESCE(contract_time, 'full_time') AS contract_time, city, latitude "
             f"FROM ({fx.events_as_ads_sql()})")


@register("sink_swap", _SWAP_SQL)
def sink_swap(spark, sf_dir):
    """Read a table, change it, write it back over itself (write-then-swap)."""
    path = sinks.scratch_path(spark, "swap")
    ads = fx.events_as_ads(spark, sf_dir).select("id", "contract_time", "city", "latitude")
    sinks.write_overwrite(ads, path)
    current = spark.read.parquet(path)
    sinks.write_swap(clean.fill_defaults(current), path)
    return spark.read.parquet(path)


# --- raw JSON -----------------------------------------------------------------
_RAW_TEXT_SCHEMA = StructType([StructField(n, StringType()) for n, _ in RAW_FIELDS])
_RAW_COLS = [n for n, _ in RAW_FIELDS]


def _write_raw_json(spark, sf_dir, broken: bool) -> str:
    path = sinks.scratch_path(spark, "raw-json")
    raw = fx.events_as_raw(spark, sf_dir).withColumn("unknown_field", F.lit("x"))
    sinks.write_json_lines(raw, f"{path}/good")
    if broken:
        # every 'error' event also lands as a truncated line
        ev = fx.table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
        ev.select(F.concat(F.lit('{"id": "'), F.col("event_id").cast("string"), F.lit('", broken'))
                  .alias("value")).write.text(f"{path}/broken")
    return path


_RAW_TYPED = """
SELECT CAST(event_id AS VARCHAR) AS id,
       CASE WHEN event_id % 8 = 0 THEN NULL ELSE ts END AS created,
       concat('Area ', CAST(user_id % 40 AS VARCHAR)) AS location_display_name,
       'US' AS {country},
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('S', CAST(user_id % 7 AS VARCHAR)) END AS {state},
       concat('C', CAST(user_id % 11 AS VARCHAR)) AS {county},
       concat('T', CAST(user_id % 13 AS VARCHAR)) AS {city},
       {lat} AS latitude, {lon} AS longitude,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'part_time' END AS contract_time,
       'permanent' AS contract_type, concat(event_type, '-jobs') AS category_tag,
       upper(event_type) AS category_label,
       concat('Co', CAST(user_id % 17 AS VARCHAR)) AS {company},
       concat(upper(event_type), ' role') AS title, props AS description,
       {flag} AS salary_is_predicted,
       {smin} AS salary_min, {smax} AS salary_max,
       concat('https://ads.example/', CAST(event_id AS VARCHAR)) AS redirect_url
FROM events"""

_TYPED_VALUES = dict(
    lat="CASE WHEN event_id % 10 = 0 THEN NULL ELSE CAST(user_id % 90 AS DOUBLE) + 0.5 END",
    lon="-(CAST(user_id % 180 AS DOUBLE) + 0.25)",
    flag="CASE WHEN event_id % 6 IN (0, 1) THEN NULL ELSE value > 50 END",
    smin="CAST(CAST(floor(value) AS BIGINT) AS DOUBLE)",
    smax="CASE WHEN event_id % 12 = 0 THEN NULL ELSE CAST(CAST(floor(value) AS BIGINT) * 2 AS DOUBLE) END",
)
_STAGE1_NAMES = dict(country="country", state="state", county="county", city="city", company="company_name")
_RAW_NAMES = dict(country="location_Country", state="location_State", county="location_County",
                  city="location_City", company="company_display_name")
_TEXT_VALUES = dict(
    lat="CASE WHEN event_id % 10 = 0 THEN 'abc' ELSE concat(CAST(user_id % 90 AS VARCHAR), '.5') END",
    lon="concat('-', CAST(user_id % 180 AS VARCHAR), '.25')",
    flag=("CASE WHEN event_id % 6 = 0 THEN NULL WHEN event_id % 6 = 1 THEN 'x' "
          "WHEN value > 50 THEN '1' ELSE '0' END"),
    smin="CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)",
    smax="CASE WHEN event_id % 12 = 0 THEN 'n/a' ELSE CAST(CAST(floor(value) AS BIGINT) * 2 AS VARCHAR) END",
)
STAGE1_SQL = _RAW_TYPED.format(**_STAGE1_NAMES, **_TYPED_VALUES)
RAW_READ_SQL = _RAW_TYPED.format(**_RAW_NAMES, **_TEXT_VALUES)
_NULL_ROW = ", ".join(f"NULL AS {c}" for c in _RAW_COLS)


@register("scan_json_schema", f"""
{RAW_READ_SQL}
UNION ALL
SELECT {_NULL_ROW} FROM events WHERE event_type = 'error'""")
def scan_json_schema(spark, sf_dir):
    """Fixed-schema read; unknown field dropped, bad timestamp -> null,
    broken line -> all-null row."""
    path = _write_raw_json(spark, sf_dir, broken=True)
    return _ntz(readers.read_raw_json(spark, [f"{path}/good", f"{path}/broken"]), "created")


@register("sink_json_lines", f"SELECT *, 20 AS n_keys FROM ({fx.events_as_raw_sql()})")
def sink_json_lines(spark, sf_dir):
    """JSON lines keep every field, nulls as ``null`` (20 keys per line)."""
    path = sinks.scratch_path(spark, "json-lines")
    sinks.write_json_lines(fx.events_as_raw(spark, sf_dir), path)
    lines = spark.read.text(path)
    parsed = lines.select(F.from_json("value", _RAW_TEXT_SCHEMA).alias("r"),
                          F.size(F.json_object_keys("value")).alias("n_keys"))
    return parsed.select("r.*", "n_keys")


@register("rename_cast", STAGE1_SQL)
def rename_cast(spark, sf_dir):
    return _ntz(ingest.rename_cast(fx.events_as_raw(spark, sf_dir)), "created")


@register("flag_to_bool", f"SELECT id, salary_is_predicted FROM ({STAGE1_SQL})")
def flag_to_bool(spark, sf_dir):
    raw = fx.events_as_raw(spark, sf_dir)
    return raw.select("id", sc.flag_to_bool("salary_is_predicted").alias("salary_is_predicted"))


@register("stage1", STAGE1_SQL)
def stage1(spark, sf_dir):
    """Raw JSON lines -> schema read -> renames and casts."""
    path = _write_raw_json(spark, sf_dir, broken=False)
    return _ntz(ingest.ingest(readers.read_raw_json(spark, f"{path}/good")), "created")


# --- nested documents ---------------------------------------------------------
_F5_SQL = """
SELECT c_custkey, c_name, c_mktsegment, c_acctbal, n_name, r_name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
_AREA4 = "c_custkey % 13 <> 0 AND c_custkey % 17 <> 0 AND c_custkey % 5 <> 0"


@register("flatten_ads", f"""
SELECT c_mktsegment AS title, CAST(NULL AS DOUBLE) AS salary_max, c_acctbal AS salary_min,
       CAST(NULL AS VARCHAR) AS salary_is_predicted, c_name AS description,
       concat('https://ads.example/c/', CAST(c_custkey AS VARCHAR)) AS redirect_url,
       CAST(c_custkey AS VARCHAR) AS id, CAST(NULL AS VARCHAR) AS created,
       CAST(NULL AS VARCHAR) AS contract_type, CAST(NULL AS VARCHAR) AS contract_time,
       r_name AS category_label, lower(r_name) AS category_tag,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_name END AS company_display_name,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE n_name END AS location_display_name,
       CASE WHEN {_AREA4} THEN 'US' END AS location_Country,
       CASE WHEN {_AREA4} THEN r_name END AS location_State,
       CASE WHEN {_AREA4} THEN n_name END AS location_County,
       CASE WHEN {_AREA4} THEN c_mktsegment END AS location_City,
       CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude
FROM ({_F5_SQL})""")
def flatten_ads(spark, sf_dir):
    docs = ingest.parse_json(fx.customer_api_docs(spark, sf_dir), "doc_text", API_RESULT_SCHEMA)
    return ingest.flatten_ads(docs)


@register("area_to_columns", f"""
SELECT CAST(c_custkey AS VARCHAR) AS id,
       CASE WHEN {_AREA4} THEN 'US' END AS location_Country,
       CASE WHEN {_AREA4} THEN r_name END AS location_State,
       CASE WHEN {_AREA4} THEN n_name END AS location_County,
       CASE WHEN {_AREA4} THEN c_mktsegment END AS location_City
FROM ({_F5_SQL})""")
def area_to_columns(spark, sf_dir):
    docs = ingest.parse_json(fx.customer_api_docs(spark, sf_dir), "doc_text", API_RESULT_SCHEMA)
    return docs.select(F.col("doc")["id"].alias("id"),
                       *[c.alias(n) for n, c in ingest.area_columns(F.col("doc")["location"]["area"]).items()])


@register("flatten_nested_results", """
SELECT o_orderkey AS doc_id, i,
       concat(o_orderpriority, ' #', CAST(i AS VARCHAR)) AS position_title,
       concat('Org ', CAST(o_custkey % 100 AS VARCHAR)) AS organization_name,
       concat('https://jobs.example/', CAST(o_orderkey AS VARCHAR), '/', CAST(i AS VARCHAR)) AS position_uri,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE concat('Loc ', CAST(o_custkey % 50 AS VARCHAR)) END
           AS location_name
FROM orders, (VALUES (1), (2)) AS t(i)
WHERE o_orderkey % 7 <> 0""")
def flatten_nested_results(spark, sf_dir):
    docs = ingest.parse_json(fx.order_gov_docs(spark, sf_dir), "doc_text", GOV_RESULT_SCHEMA)
    return ingest.flatten_gov_results(docs)


@register("flatten_results_list", """
SELECT o_orderkey AS doc_id, i, concat(o_orderpriority, ' role ', CAST(i AS VARCHAR)) AS title,
       concat('Co', CAST(o_custkey % 17 AS VARCHAR)) AS company,
       concat('Place ', CAST(o_custkey % 30 AS VARCHAR)) AS place,
       concat('https://ads.example/o/', CAST(o_orderkey AS VARCHAR), '/', CAST(i AS VARCHAR)) AS redirect_url
FROM orders, (VALUES (1), (2), (3)) AS t(i)""")
def flatten_results_list(spark, sf_dir):
    docs = ingest.parse_json(fx.order_result_lists(spark, sf_dir), "doc_text", RESULT_LIST_SCHEMA)
    return ingest.flatten_result_list(docs)


# --- stage 2/3 pieces over F2 --------------------------------------------------
_F2 = fx.events_as_ads_sql()


@register("fill_default", f"SELECT id, COALESCE(contract_time, 'full_time') AS contract_time FROM ({_F2})")
def fill_default(spark, sf_dir):
    return clean.fill_defaults(fx.events_as_ads(spark, sf_dir)).select("id", "contract_time")


@register("filter_has_coords",
          f"SELECT id, latitude, longitude FROM ({_F2}) WHERE latitude IS NOT NULL AND longitude IS NOT NULL")
def filter_has_coords(spark, sf_dir):
    return clean.drop_missing_coordinates(fx.events_as_ads(spark, sf_dir)).select("id", "latitude", "longitude")


@register("missing_locations", f"""
SELECT DISTINCT longitude, latitude FROM ({_F2})
WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  AND (city IS NULL OR county IS NULL OR state IS NULL OR country IS NULL)""")
def missing_locations(spark, sf_dir):
    return geo.missing_locations(clean.drop_missing_coordinates(fx.events_as_ads(spark, sf_dir)))


_TOD = ("CASE WHEN hour(created) >= 5 AND hour(created) < 12 THEN 'morning' "
        "WHEN hour(created) >= 12 AND hour(created) < 17 THEN 'afternoon' "
        "WHEN hour(created) >= 17 AND hour(created) < 21 THEN 'evening' ELSE 'night' END")


@register("time_of_day", f"""
SELECT id, CAST(hour(created) AS INTEGER) AS created_hour, {_TOD} AS created_time_of_day FROM ({_F2})""")
def time_of_day(spark, sf_dir):
    return add_time_parts(fx.events_as_ads(spark, sf_dir)).select("id", "created_hour", "created_time_of_day")


@register("created_parts", f"""
SELECT id, created AS created_ts, CAST(created AS DATE) AS created_date,
       CAST(hour(created) AS INTEGER) AS created_hour FROM ({_F2})""")
def created_parts(spark, sf_dir):
    df = fx.events_as_ads(spark, sf_dir).withColumns(sc.created_parts("created"))
    return _ntz(df.select("id", "created_ts", "created_date", "created_hour"), "created_ts")


@register("keyword_flag", """
SELECT doc_id, COALESCE(regexp_matches(lower(CASE WHEN doc_id % 9 = 0 THEN NULL ELSE text END),
                                       'license|copyright'), false) AS has_keyword
FROM documents""")
def keyword_flag(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    desc = F.when(F.col("doc_id") % 9 != 0, F.col("text"))
    return docs.select("doc_id", sc.keyword_flag(desc, "license|copyright").alias("has_keyword"))


@register("stage3_features", f"""
SELECT id, created, location_display_name, country, state, county, city, latitude, longitude,
       COALESCE(contract_time, 'full_time') AS contract_time, category_label, company_name, title,
       description, salary_is_predicted, salary_min, salary_max, redirect_url,
       created AS created_ts, CAST(created AS DATE) AS created_date,
       CAST(hour(created) AS INTEGER) AS created_hour, {_TOD} AS created_time_of_day,
       COALESCE(regexp_matches(lower(description), 'bonus|benefit'), false) AS has_bonus_or_benefit
FROM ({_F2})""")
def stage3_features(spark, sf_dir):
    return _ntz(add_features(fx.events_as_ads(spark, sf_dir)), "created_ts")


# --- windows -----------------------------------------------------------------
_EV_NULL = "SELECT event_id, event_type, CASE WHEN event_id % 4 = 0 THEN NULL ELSE ts END AS created FROM events"


@register("ffill_created", f"""
SELECT event_id, event_type,
       last_value(created IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS created
FROM ({_EV_NULL})""")
def ffill_created(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.when(F.col("event_id") % 4 != 0, F.col("ts")).alias("created"))
    return clean.forward_fill(ev, "created", "event_id", ["event_type"], n_blocks=64)


@register("ffill_self_order", f"""
SELECT id, last_value(created IGNORE NULLS) OVER (ORDER BY created NULLS FIRST
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS created
FROM ({_F2})""")
def ffill_self_order(spark, sf_dir):
    return clean.fill_created_reference(fx.events_as_ads(spark, sf_dir).select("id", "created"))


# --- places -------------------------------------------------------------------
_PLACES_NORM = f"""
SELECT longitude, latitude, city, county, state, country FROM (
  SELECT *, row_number() OVER (PARTITION BY longitude, latitude
                               ORDER BY city NULLS FIRST, county NULLS FIRST, state NULLS FIRST,
                                        country NULLS FIRST) AS rn
  FROM (SELECT longitude, latitude,
               COALESCE(NULLIF(trim(city), ''), NULLIF(trim(town), ''), NULLIF(trim(road), '')) AS city,
               county, state, upper(country) AS country
        FROM ({fx.supplier_places_sql()})))
WHERE rn = 1"""


@register("place_name_fallback", f"""
SELECT longitude, latitude,
       COALESCE(NULLIF(trim(city), ''), NULLIF(trim(town), ''), NULLIF(trim(road), '')) AS city_name
FROM ({fx.supplier_places_sql()})""")
def place_name_fallback(spark, sf_dir):
    p = fx.supplier_places(spark, sf_dir)
    return p.select("longitude", "latitude", sc.place_name_fallback("city", "town", "road").alias("city_name"))


@register("geo_fill", f"""
SELECT a.id, COALESCE(a.city, p.city) AS city, COALESCE(a.county, p.county) AS county,
       COALESCE(a.state, p.state) AS state, COALESCE(a.country, p.country) AS country
FROM ({_F2}) a LEFT JOIN ({_PLACES_NORM}) p ON a.longitude = p.longitude AND a.latitude = p.latitude
WHERE a.latitude IS NOT NULL AND a.longitude IS NOT NULL""")
def geo_fill(spark, sf_dir):
    ads = clean.drop_missing_coordinates(fx.events_as_ads(spark, sf_dir))
    return geo.fill_from_lookup(ads, fx.supplier_places(spark, sf_dir)) \
        .select("id", "city", "county", "state", "country")


_HAV = ("2 * 6371.0 * asin(sqrt(least(1.0, pow(sin((radians(p.latitude) - radians(q.latitude)) / 2), 2) "
        "+ cos(radians(q.latitude)) * cos(radians(p.latitude)) "
        "* pow(sin((radians(p.longitude) - radians(q.longitude)) / 2), 2))))")


@register("reverse_geocode", f"""
WITH q AS ({fx.customer_points_sql(2)}), p AS ({_PLACES_NORM}),
d AS (SELECT q.point_id, p.longitude AS plon, p.latitude AS plat, p.city, p.county, p.state, p.country,
             {_HAV} AS dist FROM q, p),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY point_id ORDER BY dist, plon, plat) AS rn
                        FROM d) WHERE rn = 1)
SELECT q.point_id, q.longitude, q.latitude, best.city, best.county, best.state, best.country
FROM q LEFT JOIN best ON q.point_id = best.point_id""")
def reverse_geocode(spark, sf_dir):
    pts = fx.customer_points(spark, sf_dir, offset=2)
    return geo.reverse_geocode(pts, fx.supplier_places(spark, sf_dir)).drop("distance_km")


_STAGE2_COLS = ("id, CAST(created AS VARCHAR) AS created, location_display_name, country, state, county, city, "
                "latitude, longitude, contract_time, contract_type, category_tag, category_label, company_name, "
                "title, description, salary_is_predicted, salary_min, salary_max, redirect_url")


def _stage2_sql() -> str:
    from adpulse.plans.q_monthly import _DEDUP_SQL

    return f"""
WITH d AS ({_DEDUP_SQL}), c AS (SELECT * FROM d WHERE latitude IS NOT NULL AND longitude IS NOT NULL)
SELECT id, CAST(created AS VARCHAR) AS created, location_display_name,
       COALESCE(c.country, p.country) AS country, COALESCE(c.state, p.state) AS state,
       COALESCE(c.county, p.county) AS county, COALESCE(c.city, p.city) AS city,
       c.latitude, c.longitude, contract_time, contract_type, category_tag, category_label, company_name,
       title, description, salary_is_predicted, salary_min, salary_max, redirect_url
FROM c LEFT JOIN ({_PLACES_NORM}) p ON c.longitude = p.longitude AND c.latitude = p.latitude"""


@register("stage2", _stage2_sql())
def stage2(spark, sf_dir):
    """Dedup -> fill created -> coordinates -> places (lookup) -> created as text."""
    return clean_and_locate(fx.events_as_ads(spark, sf_dir, dup=True), fx.supplier_places(spark, sf_dir))


# --- scalar groups over F1 / F3 ---------------------------------------------------
@register("clamp_ceil_step", """
SELECT p_partkey, least(greatest(p_retailprice / 300, 0.25::DOUBLE), 6.25::DOUBLE) AS clamped,
       CAST(ceil(least(greatest(p_retailprice / 300, 0.25::DOUBLE), 6.25::DOUBLE) / 0.25::DOUBLE) AS DOUBLE)
           * 0.25::DOUBLE AS stepped
FROM part""")
def clamp_ceil_step(spark, sf_dir):
    p = fx.table(spark, sf_dir, "part")
    x = sc.clamp(F.col("p_retailprice") / F.lit(300), 0.25, 6.25)
    return p.select("p_partkey", x.alias("clamped"), sc.ceil_step(x, 0.25).alias("stepped"))


@register("guarded_ratios", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_discount > 0 THEN l_extendedprice / l_discount END AS price_per_discount,
       l_tax / NULLIF(l_quantity - 25, 0) AS tax_per_extra_unit
FROM lineitem""")
def guarded_ratios(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     sc.ratio_if_positive("l_extendedprice", "l_discount").alias("price_per_discount"),
                     sc.ratio_nullif("l_tax", F.col("l_quantity") - F.lit(25)).alias("tax_per_extra_unit"))


@register("remaining_days", """
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date,
       CAST(datediff('day', CAST(l_shipdate AS DATE),
                     CAST(date_trunc('month', CAST(l_shipdate AS DATE)) + INTERVAL 1 MONTH AS DATE)) AS INTEGER)
           AS remaining_days
FROM lineitem""")
def remaining_days(spark, sf_dir):
    li = fx.table(spark, sf_dir, "lineitem").withColumn("date", F.col("l_shipdate").cast("date"))
    return li.select("l_orderkey", "l_linenumber", "date", sc.remaining_days("date").alias("remaining_days"))


# --- search list --------------------------------------------------------------------
_TITLES_SQL = ", ".join(f"('{t}')" for t in search.DEFAULT_TITLES)
# Places to search: every supplier's location (nation as state, supplier as
# city), so the list grows with the data.
_GRID_SQL = f"""
SELECT t.title AS Job_Title, n_name AS State, s_name AS City
FROM supplier JOIN nation ON s_nationkey = n_nationkey, (VALUES {_TITLES_SQL}) AS t(title)"""


def _grid_places(spark, sf_dir):
    s = fx.table(spark, sf_dir, "supplier")
    n = fx.table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("n_name").alias("State"),
                                                            F.col("s_name").alias("City"))


@register("search_grid", _GRID_SQL)
def search_grid(spark, sf_dir):
    return search.search_grid(_grid_places(spark, sf_dir))


@register("scan_search_csv", _GRID_SQL)
def scan_search_csv(spark, sf_dir):
    """The search list as CSV with ', ' separators (leading spaces), read
    back with the spaces dropped."""
    spaced = _grid_places(spark, sf_dir).select(F.concat(F.lit(" "), F.col("State")).alias("State"),
                                                F.concat(F.lit(" "), F.col("City")).alias("City"))
    path = sinks.scratch_path(spark, "search-csv")
    sinks.write_search_csv(search.search_grid(spaced), path)
    return readers.read_search_csv(spark, path)


@register("latest_k_per_search", """
SELECT o_custkey, o_orderkey, o_orderdate, rank FROM (
  SELECT o_custkey, o_orderkey, o_orderdate,
         CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS INTEGER)
             AS rank
  FROM orders) WHERE rank <= 20""")
def latest_k_per_search(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return search.latest_k(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], 20)


def _final_sql() -> str:
    from adpulse.functions.keyed_random import SqlDraws
    from adpulse.plans.q_synthetic import _bid_sql

    d = SqlDraws("bid", ["id"], normals=1)
    tod = _TOD.replace("hour(created)", "hour(created_ts)")
    return f"""
WITH s2 AS ({_stage2_sql()}),
s3 AS (SELECT id, created, location_display_name, country, state, county, city, latitude, longitude,
              COALESCE(contract_time, 'full_time') AS contract_time, category_label, company_name, title,
              description, salary_is_predicted, salary_min, salary_max, redirect_url,
              CAST(created AS TIMESTAMP) AS created_ts
       FROM s2)
SELECT id, created, location_display_name, country, state, county, city, latitude, longitude, contract_time,
       category_label, company_name, title, description, salary_is_predicted, salary_min, salary_max,
       redirect_url, created_ts, CAST(created_ts AS DATE) AS created_date,
       CAST(hour(created_ts) AS INTEGER) AS created_hour, {tod} AS created_time_of_day,
       COALESCE(regexp_matches(lower(description), 'bonus|benefit'), false) AS has_bonus_or_benefit,
       {_bid_sql(d.normal(0))} AS bid
FROM (SELECT *, {d.hash_select()} FROM s3)"""


@register("final_ads", _final_sql())
def final_ads(spark, sf_dir):
    """C1-C4 fused: stage-1 ads -> stage 2 -> stage 3 -> final (bid)."""
    from adpulse.operators.stages import finalize

    ads = fx.events_as_ads(spark, sf_dir, dup=True)
    final = finalize(add_features(clean_and_locate(ads, fx.supplier_places(spark, sf_dir))))
    return _ntz(final, "created_ts")


_HAV_ADS = _HAV.replace("q.latitude", "a.latitude").replace("q.longitude", "a.longitude")


@register("geo_fill_nearest", f"""
WITH a AS (SELECT * FROM ({_F2}) WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
pts AS (SELECT DISTINCT longitude, latitude FROM a
        WHERE city IS NULL OR county IS NULL OR state IS NULL OR country IS NULL),
p AS ({_PLACES_NORM}),
d AS (SELECT a.longitude AS qlon, a.latitude AS qlat, p.longitude AS plon, p.latitude AS plat,
             p.city, p.county, p.state, p.country, {_HAV_ADS} AS dist
      FROM pts a, p),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qlon, qlat ORDER BY dist, plon, plat) AS rn
                        FROM d) WHERE rn = 1)
SELECT a.id, COALESCE(a.city, b.city) AS city, COALESCE(a.county, b.county) AS county,
       COALESCE(a.state, b.state) AS state, COALESCE(a.country, b.country) AS country
FROM a LEFT JOIN best b ON a.longitude = b.qlon AND a.latitude = b.qlat""")
def geo_fill_nearest(spark, sf_dir):
    """J9 inside C2: incomplete places filled from the nearest place."""
    ads = clean.drop_missing_coordinates(fx.events_as_ads(spark, sf_dir))
    return geo.fill_from_nearest(ads, fx.supplier_places(spark, sf_dir)) \
        .select("id", "city", "county", "state", "country")
