"""Queries over raw lines that drift from the schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from adpulse import fixtures as fx
from adpulse.operators import rescue
from adpulse.plans.catalog import register
from adpulse.sources import sinks


def _lines(spark, sf_dir):
    """Raw ads as text files: unknown fields, titles that are objects, times that are none, cut lines."""
    raw = fx.events_as_raw(spark, sf_dir)
    raw = raw.withColumn("n", F.col("id").cast("long"))
    fields = [c for c in raw.columns if c not in ("title", "n")]
    line = F.to_json(F.struct(*fields))
    title = F.when(F.col("n") % 13 == 0, F.concat(F.lit('{"text":"'), F.col("title"), F.lit('"}'))).otherwise(
        F.concat(F.lit('"'), F.col("title"), F.lit('"')))
    parts = [F.expr("substring(line, 1, length(line) - 1)"), F.lit(',"title":'), F.col("titled"),
             F.when(F.col("n") % 7 == 0, ',"remote":true').otherwise(""),
             F.when(F.col("n") % 11 == 0, F.concat(F.lit(',"employer":{"no":'), F.col("n"), F.lit(',"tags":["x"]}'))).otherwise(""),
             F.when(F.col("n") % 17 == 0, "").otherwise("}")]
    path = sinks.scratch_path(spark, "drifting-lines")
    raw.select("n", line.alias("line"), title.alias("titled")).select(F.concat(*parts).alias("value")).write.text(path)
    return rescue.read_rescued(spark, path)


@register("json_rescued", """
SELECT CAST(event_id AS VARCHAR) AS id, CASE WHEN event_id % 13 <> 0 THEN concat(upper(event_type), ' role') END AS title,
       CASE WHEN event_id % 8 <> 0 THEN ts END AS created, props AS description,
       CASE WHEN event_id % 7 = 0 THEN true END AS remote, CASE WHEN event_id % 11 = 0 THEN event_id END AS employer,
       CASE WHEN event_id % 13 = 0 THEN concat(upper(event_type), ' role') END AS title_text,
       concat_ws(',', CASE WHEN event_id % 8 = 0 THEN 'created' END, CASE WHEN event_id % 11 = 0 THEN 'employer' END,
                 CASE WHEN event_id % 7 = 0 THEN 'remote' END, CASE WHEN event_id % 13 = 0 THEN 'title' END) AS fields
FROM events WHERE event_id % 17 <> 0""")
def json_rescued(spark, sf_dir):
    """Typed columns beside the fields that the schema has no place for."""
    good, _ = _lines(spark, sf_dir)

    def field(name, path, kind):
        return F.try_variant_get(F.try_element_at(rescue.RESCUED, F.lit(name)), path, kind)
    return good.select(
        "id", "title", F.col("created").cast("timestamp_ntz").alias("created"), "description",
        field("remote", "$", "boolean").alias("remote"), field("employer", "$.no", "long").alias("employer"),
        field("title", "$.text", "string").alias("title_text"),
        F.coalesce(F.array_join(F.array_sort(F.map_keys(rescue.RESCUED)), ","), F.lit("")).alias("fields"))


@register("json_drift", """
WITH good AS (SELECT event_id AS n FROM events WHERE event_id % 17 <> 0)
SELECT * FROM (
  SELECT 'remote' AS field, 'unknown' AS reason, count(*) AS lines, 'BOOLEAN' AS type FROM good WHERE n % 7 = 0
  UNION ALL SELECT 'employer', 'unknown', count(*), 'OBJECT<no: BIGINT, tags: ARRAY<STRING>>' FROM good WHERE n % 11 = 0
  UNION ALL SELECT 'title', 'mistyped', count(*), 'OBJECT<text: STRING>' FROM good WHERE n % 13 = 0
  UNION ALL SELECT 'created', 'mistyped', count(*), 'STRING' FROM good WHERE n % 8 = 0
  UNION ALL SELECT '', 'broken line', count(*), '' FROM events WHERE event_id % 17 = 0) WHERE lines > 0""")
def json_drift(spark, sf_dir):
    """What drifted from the schema, how often and of which type; broken lines counted with it."""
    good, broken = _lines(spark, sf_dir)
    cut = broken.agg(F.count(F.lit(1)).alias("lines")).filter("lines > 0").select(
        F.lit("").alias("field"), F.lit("broken line").alias("reason"), "lines", F.lit("").alias("type"))
    return rescue.drift_report(good).unionByName(cut)
