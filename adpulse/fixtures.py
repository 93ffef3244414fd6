"""Adapters that shape the driver's tables like the pipeline's datasets.

Each adapter exists twice: as a DataFrame builder (Spark) and as a SQL
``SELECT`` over the same parquet views (DuckDB oracle).  Adapter column
expressions that only derive inputs (not the operator under test) are written
once in the dialect both engines share and used on both sides.  Nulls and
duplicates are derived from keys with CASE, never by filtering rows away, so
every adapter keeps the whole table.

F1  parts as ads/jobs     part        -> job_id, title, city, company, state, bid
F2  events as ads         events      -> 20-column stage-1 ad (nulls derived)
F3  lineitem as clicks    lineitem    -> job_id, date, cost (DECIMAL), is_applicant
F4  documents as text     documents   -> id, description
F5  nested documents      customer x nation x region -> nested JSON ads
F6  coordinates           supplier (places) / customer (queries)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.functions.keyed_random import SqlDraws


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select_exprs(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(e).alias(k) for k, e in exprs.items()])


def _sql_select(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e} AS {k}" for k, e in exprs.items())


# ---------------------------------------------------------------------------
# F1 parts as ads / jobs; campaigns per (brand, type)
# ---------------------------------------------------------------------------
# bid: price / 300 rounded up to a 0.25 step, so sums of bids are exact.
F1_EXPRS = {
    "job_id": "p_partkey",
    "title": "p_name",
    "city": "p_type",
    "company_name": "p_brand",
    "state": "p_type",
    "bid": "CAST(ceil(p_retailprice / 300 / 0.25) AS DOUBLE) * 0.25",
}
# Variant with null keys: no company every 50th part, no state every 7th.
F1_NULL_EXPRS = {
    **F1_EXPRS,
    "company_name": "CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_brand END",
    "state": "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_type END",
}

# Variant whose keys grow with the data: a firm for every four parts.
F1_WIDE_EXPRS = {
    **F1_EXPRS,
    "company_name": "concat('firm ', CAST(CAST(floor(p_partkey / 4) AS BIGINT) AS STRING))",
}


def _f1_exprs_spark(exprs: dict[str, str]) -> dict[str, str]:
    # Spark reads 0.25 as DECIMAL; keep the double arithmetic of DuckDB.
    return {k: v.replace("* 0.25", "* CAST(0.25 AS DOUBLE)").replace("/ 0.25", "/ CAST(0.25 AS DOUBLE)")
            for k, v in exprs.items()}


def parts_as_ads(spark, sf_dir, with_nulls: bool = False, wide: bool = False) -> DataFrame:
    exprs = F1_WIDE_EXPRS if wide else F1_NULL_EXPRS if with_nulls else F1_EXPRS
    return _select_exprs(table(spark, sf_dir, "part"), _f1_exprs_spark(exprs))


def parts_as_ads_sql(with_nulls: bool = False, wide: bool = False) -> str:
    exprs = F1_WIDE_EXPRS if wide else F1_NULL_EXPRS if with_nulls else F1_EXPRS
    return f"SELECT {_sql_select(exprs)} FROM part"


CAMPAIGN_BUDGET_FIXTURE = 5_000_000


def campaigns_from_parts(spark, sf_dir, wide: bool = False) -> DataFrame:
    """Mart fixture: one campaign per (brand, type), ids numbered from 1001 in
    key order, cpa_target = trunc(avg_bid * 30), fixed budget and margin."""
    from adpulse.operators.numbering import assign_ids

    ads = parts_as_ads(spark, sf_dir, wide=wide)
    groups = (ads.groupBy("company_name", "state")
              .agg((F.avg("bid") * F.lit(30.0)).cast("int").alias("cpa_target")))
    return (assign_ids(groups, ["company_name", "state"], F.lit(1000).cast("long"))
            .select("campaign_id", "company_name", "state", "cpa_target",
                    F.lit(CAMPAIGN_BUDGET_FIXTURE).alias("budget"),
                    F.lit(0.3).alias("margin")))


def campaigns_from_parts_sql(wide: bool = False) -> str:
    return f"""
    SELECT CAST(1000 + row_number() OVER (ORDER BY company_name NULLS FIRST, state NULLS FIRST) AS BIGINT) AS campaign_id,
           company_name, state, cpa_target, {CAMPAIGN_BUDGET_FIXTURE} AS budget, 0.3::DOUBLE AS margin
    FROM (SELECT company_name, state, CAST(trunc(avg(bid) * 30.0::DOUBLE) AS INTEGER) AS cpa_target
          FROM ({parts_as_ads_sql(wide=wide)}) GROUP BY company_name, state)"""


def jobs_from_parts(spark, sf_dir, wide: bool = False) -> DataFrame:
    return parts_as_ads(spark, sf_dir, wide=wide).select("job_id", "title", "city", "company_name", "state")


def jobs_from_parts_sql(wide: bool = False) -> str:
    return f"SELECT job_id, title, city, company_name, state FROM ({parts_as_ads_sql(wide=wide)})"


# F1 over orders: a campaign key for every customer and priority, some parts null.
F1_ORDERS_EXPRS = {
    "job_id": "o_orderkey",
    "company_name": "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE concat('Customer ', CAST(o_custkey AS STRING)) END",
    "state": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END",
    "bid": "CAST(ceil(o_totalprice / 100000 / 0.25) AS DOUBLE) * 0.25",
}


def orders_as_ads(spark, sf_dir) -> DataFrame:
    return _select_exprs(table(spark, sf_dir, "orders"), _f1_exprs_spark(F1_ORDERS_EXPRS))


def orders_as_ads_sql() -> str:
    return f"SELECT {_sql_select(F1_ORDERS_EXPRS)} FROM orders"


# ---------------------------------------------------------------------------
# F3 lineitem as clicks
# ---------------------------------------------------------------------------
F3_EXPRS = {
    "job_id": "l_partkey",
    "date": "CAST(l_shipdate AS DATE)",
    "cost": "CAST(l_extendedprice AS DECIMAL(12,2))",
    "is_applicant": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
}


def lineitem_as_clicks(spark, sf_dir) -> DataFrame:
    return _select_exprs(table(spark, sf_dir, "lineitem"), F3_EXPRS)


def lineitem_as_clicks_sql() -> str:
    return f"SELECT {_sql_select(F3_EXPRS)} FROM lineitem"


# ---------------------------------------------------------------------------
# F2 events as ads (stage-1 schema, nulls derived from event_id)
# ---------------------------------------------------------------------------
def _f2_exprs(dup: bool) -> dict[str, str]:
    return {
        "id": "CAST(user_id AS STRING)" if dup else "CAST(event_id AS STRING)",
        "created": "CASE WHEN event_id % 4 = 0 THEN NULL ELSE ts END",
        "location_display_name": "concat('Area ', CAST(user_id % 40 AS STRING))",
        "country": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE 'US' END",
        "state": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('S', CAST(user_id % 7 AS STRING)) END",
        "county": "CASE WHEN event_id % 6 = 0 THEN NULL ELSE concat('C', CAST(user_id % 11 AS STRING)) END",
        "city": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE concat('T', CAST(user_id % 13 AS STRING)) END",
        "latitude": "CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST((user_id * 73) % 1200 AS DOUBLE) / 10 - 60 END",
        "longitude": "CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST((user_id * 151) % 3600 AS DOUBLE) / 10 - 180 END",
        "contract_time": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'part_time' END",
        "contract_type": "'permanent'",
        "category_tag": "concat(event_type, '-jobs')",
        "category_label": "upper(event_type)",
        "company_name": "concat('Co', CAST(user_id % 17 AS STRING))",
        "title": "concat(upper(event_type), ' role')",
        "description": "CASE WHEN event_id % 8 = 0 THEN NULL ELSE props END",
        "salary_is_predicted": "value > 50",
        "salary_min": "value",
        "salary_max": "value * 2",
        "redirect_url": "concat('https://ads.example/', CAST(event_id AS STRING))",
    }


def events_as_ads(spark, sf_dir, dup: bool = False) -> DataFrame:
    """Stage-1 shaped ads; ``dup`` keys them by user, so ids repeat."""
    ev = table(spark, sf_dir, "events")
    return _select_exprs(ev, _f2_exprs(dup)).withColumn(
        "created", F.col("created").cast("timestamp_ntz"))


def events_as_ads_sql(dup: bool = False) -> str:
    return f"SELECT {_sql_select(_f2_exprs(dup))} FROM events"


# Raw JSON text per field (as the extraction writes it): numbers as text, a
# non-numeric latitude every 10th row, a bad timestamp every 8th, flags as 1/0.
def _raw_exprs() -> dict[str, str]:
    return {
        "id": "CAST(event_id AS STRING)",
        "created": ("CASE WHEN event_id % 8 = 0 THEN 'not-a-time' "
                    "ELSE concat(strftime_iso, 'Z') END"),
        "location_display_name": "concat('Area ', CAST(user_id % 40 AS STRING))",
        "location_Country": "'US'",
        "location_State": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('S', CAST(user_id % 7 AS STRING)) END",
        "location_County": "concat('C', CAST(user_id % 11 AS STRING))",
        "location_City": "concat('T', CAST(user_id % 13 AS STRING))",
        "latitude": ("CASE WHEN event_id % 10 = 0 THEN 'abc' "
                     "ELSE concat(CAST(user_id % 90 AS STRING), '.5') END"),
        "longitude": "concat('-', CAST(user_id % 180 AS STRING), '.25')",
        "contract_time": "CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'part_time' END",
        "contract_type": "'permanent'",
        "category_tag": "concat(event_type, '-jobs')",
        "category_label": "upper(event_type)",
        "company_display_name": "concat('Co', CAST(user_id % 17 AS STRING))",
        "title": "concat(upper(event_type), ' role')",
        "description": "props",
        "salary_is_predicted": ("CASE WHEN event_id % 6 = 0 THEN NULL WHEN event_id % 6 = 1 THEN 'x' "
                                "WHEN value > 50 THEN '1' ELSE '0' END"),
        "salary_min": "CAST(CAST(floor(value) AS BIGINT) AS STRING)",
        "salary_max": "CASE WHEN event_id % 12 = 0 THEN 'n/a' ELSE CAST(CAST(floor(value) AS BIGINT) * 2 AS STRING) END",
        "redirect_url": "concat('https://ads.example/', CAST(event_id AS STRING))",
    }


RAW_ISO_SPARK = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
RAW_ISO_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"


def events_as_raw(spark, sf_dir) -> DataFrame:
    """Flat raw records (all strings), as the extraction lands them."""
    ev = table(spark, sf_dir, "events")
    exprs = {k: v.replace("strftime_iso", RAW_ISO_SPARK) for k, v in _raw_exprs().items()}
    return _select_exprs(ev, exprs)


def events_as_raw_sql() -> str:
    exprs = {k: v.replace("strftime_iso", RAW_ISO_SQL) for k, v in _raw_exprs().items()}
    return f"SELECT {_sql_select(exprs)} FROM events"


# ---------------------------------------------------------------------------
# Jobs for click generation: every event is a job; created_date null every
# 4th event (those jobs get no clicks), bid drawn by the keyed generator.
# ---------------------------------------------------------------------------
JOB_EXPRS = {
    "job_id": "CAST(event_id AS STRING)",
    "created_date": "CASE WHEN event_id % 4 = 0 THEN NULL ELSE CAST(ts AS DATE) END",
}


def events_as_jobs(spark, sf_dir) -> DataFrame:
    from adpulse.operators.synthetic import add_bid

    jobs = _select_exprs(table(spark, sf_dir, "events"), JOB_EXPRS)
    return add_bid(jobs, key="job_id")


def events_as_jobs_sql() -> str:
    d = SqlDraws("bid", ["job_id"], normals=1)
    bid = (f"CAST(ceil(least(greatest(3.25::DOUBLE + 1.0::DOUBLE * {d.normal(0)}, 0.25::DOUBLE), 6.25::DOUBLE)"
           f" / 0.25::DOUBLE) AS DOUBLE) * 0.25::DOUBLE")
    return (f"SELECT job_id, created_date, {bid} AS bid FROM ("
            f"SELECT *, {d.hash_select()} FROM (SELECT {_sql_select(JOB_EXPRS)} FROM events))")


# ---------------------------------------------------------------------------
# F6 coordinates: places from supplier, query points from customer.
# ---------------------------------------------------------------------------
def _coord(key: str, offset: int = 0) -> tuple[str, str]:
    lat = f"CAST(({key} * 73 + {offset}) % 1200 AS DOUBLE) / 10 - 60"
    lon = f"CAST(({key} * 151 + {offset}) % 3600 AS DOUBLE) / 10 - 180"
    return lat, lon


def _places_exprs() -> dict[str, str]:
    lat, lon = _coord("s_suppkey")
    return {
        "longitude": lon,
        "latitude": lat,
        "city": "CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_suppkey % 5 = 1 THEN '' ELSE concat('City', CAST(s_suppkey AS STRING)) END",
        "town": "CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE concat('Town', CAST(s_suppkey AS STRING)) END",
        "road": "concat('Road', CAST(s_suppkey AS STRING))",
        "county": "concat('County', CAST(s_nationkey AS STRING))",
        "state": "concat('State', CAST(s_nationkey % 7 AS STRING))",
        "country": "CASE WHEN s_nationkey % 2 = 0 THEN 'us' ELSE 'ca' END",
    }


def supplier_places(spark, sf_dir) -> DataFrame:
    return _select_exprs(table(spark, sf_dir, "supplier"), _places_exprs())


def supplier_places_sql() -> str:
    return f"SELECT {_sql_select(_places_exprs())} FROM supplier"


def _points_exprs(offset: int) -> dict[str, str]:
    lat, lon = _coord("c_custkey", offset)
    return {"point_id": "c_custkey", "longitude": lon, "latitude": lat}


def customer_points(spark, sf_dir, offset: int = 0) -> DataFrame:
    return _select_exprs(table(spark, sf_dir, "customer"), _points_exprs(offset))


def customer_points_sql(offset: int = 0) -> str:
    return f"SELECT {_sql_select(_points_exprs(offset))} FROM customer"


# ---------------------------------------------------------------------------
# F5 nested documents (API search results) built from customer x nation x region
# ---------------------------------------------------------------------------
def customer_api_docs(spark, sf_dir) -> DataFrame:
    """One nested ad document (JSON text) per customer: area of 4 parts, of
    2 parts every 5th, none every 17th; no company every 11th; no location
    every 13th."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    k = F.col("c_custkey")
    area = (F.when(k % 17 == 0, F.lit(None).cast("array<string>"))
            .when(k % 5 == 0, F.array(F.lit("US"), F.col("r_name")))
            .otherwise(F.array(F.lit("US"), F.col("r_name"), F.col("n_name"), F.col("c_mktsegment"))))
    company = F.when(k % 11 != 0, F.struct(F.col("c_name").alias("display_name")))
    location = F.when(k % 13 != 0, F.struct(F.col("n_name").alias("display_name"), area.alias("area")))
    doc = F.struct(
        k.cast("string").alias("id"), F.col("c_mktsegment").alias("title"),
        F.col("c_name").alias("description"), F.col("c_acctbal").alias("salary_min"),
        F.concat(F.lit("https://ads.example/c/"), k.cast("string")).alias("redirect_url"),
        company.alias("company"), location.alias("location"),
        F.struct(F.col("r_name").alias("label"), F.lower("r_name").alias("tag")).alias("category"))
    return j.select(k.alias("doc_id"), F.to_json(doc).alias("doc_text"))


def order_gov_docs(spark, sf_dir) -> DataFrame:
    """One government-jobs response per order: two items (none every 7th),
    each with two locations (none every 3rd)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")

    def item(i: int):
        locs = F.array(F.struct(F.concat(F.lit("Loc "), (F.col("o_custkey") % 50).cast("string"))
                                .alias("LocationName")),
                       F.struct(F.lit("Remote").alias("LocationName")))
        locs = F.when(k % 3 == 0, F.filter(locs, lambda _: F.lit(False))).otherwise(locs)
        return F.struct(F.struct(
            F.concat(F.col("o_orderpriority"), F.lit(f" #{i}")).alias("PositionTitle"),
            F.concat(F.lit("Org "), (F.col("o_custkey") % 100).cast("string")).alias("OrganizationName"),
            F.concat(F.lit("https://jobs.example/"), k.cast("string"), F.lit(f"/{i}")).alias("PositionURI"),
            locs.alias("PositionLocation")).alias("MatchedObjectDescriptor"))

    items = F.array(item(1), item(2))
    items = F.when(k % 7 == 0, F.filter(items, lambda _: F.lit(False))).otherwise(items)
    doc = F.struct(F.struct(items.alias("SearchResultItems")).alias("SearchResult"))
    return o.select(k.alias("doc_id"), F.to_json(doc).alias("doc_text"))


def order_result_lists(spark, sf_dir) -> DataFrame:
    """One flat ``results[]`` search response per order, three ads each."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")

    def ad(i: int):
        return F.struct(
            F.concat(F.col("o_orderpriority"), F.lit(f" role {i}")).alias("title"),
            F.struct(F.concat(F.lit("Co"), (F.col("o_custkey") % 17).cast("string")).alias("display_name"))
            .alias("company"),
            F.struct(F.concat(F.lit("Place "), (F.col("o_custkey") % 30).cast("string")).alias("display_name"))
            .alias("location"),
            F.concat(F.lit("https://ads.example/o/"), k.cast("string"), F.lit(f"/{i}")).alias("redirect_url"))

    return o.select(k.alias("doc_id"), F.to_json(F.struct(F.array(ad(1), ad(2), ad(3)).alias("results")))
                    .alias("doc_text"))
