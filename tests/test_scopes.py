"""State carried across scopes, keyword tables and mergeable audits against one pass over all rows."""

import decimal
import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from adpulse.functions.scalars import keyword_flag
from adpulse.operators import audit_days, carry, keywords, search
from adpulse.sources import sinks

from conftest import SF_SMALL


def _same(a, b):
    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)
    return rows(a) == rows(b.select(*a.columns))


@pytest.fixture
def spending(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", "c", None]), month, day, None if rng.random() < 0.2 else decimal.Decimal(rng.randint(-500, 500)) / 100)
            for month in (1, 2, 3) for day in range(1, 29) if rng.random() < 0.9]
    rows += [("late", 3, 1, decimal.Decimal("2.50")), ("hollow", 1, 1, None), ("hollow", 3, 1, decimal.Decimal(1)), ("hollow", 3, 2, None)]
    rows = [*{(k, m, d): (k, m, d, v) for k, m, d, v in rows}.values()]
    return spark.createDataFrame(rows, "job string, month int, day int, cost decimal(12,2)")


def _sums(base, df, scope, rows):
    return carry.run_scope(rows, base, scope,
                           lambda x, opening: carry.running_sum(x, ["job"], ["month", "day"], "cost", opening),
                           lambda x, opening: carry.closing_totals(x, ["job"], "cost", opening))


def test_running_sum_goes_on_over_scopes(spark, spending):
    base = sinks.scratch_path(spark, "carry")
    for month in (1, 2, 3):
        assert _sums(base, spending, f"2025-{month:02}", spending.filter(F.col("month") == month)) == []
    before = Window.partitionBy("job").orderBy("month", "day").rowsBetween(Window.unboundedPreceding, -1)
    whole = spending.withColumn("running", F.sum("cost").over(before).cast("decimal(38,2)"))
    assert _same(whole, carry.read_scopes(spark, base))
    assert dict(carry.state_before(spark, base, "2025-03").dtypes)["total"] == "decimal(38,2)"
    # An earlier scope is corrected: it tells what rests on it, and doing that again mends it.
    fixed = spending.withColumn("cost", F.when(F.col("month") == 1, (F.col("cost") + 1).cast("decimal(12,2)")).otherwise(F.col("cost")))
    assert _sums(base, fixed, "2025-01", fixed.filter("month = 1")) == ["2025-02", "2025-03"]
    for month in (2, 3):
        _sums(base, fixed, f"2025-{month:02}", fixed.filter(F.col("month") == month))
    assert _same(fixed.withColumn("running", F.sum("cost").over(before).cast("decimal(38,2)")), carry.read_scopes(spark, base))


def test_empty_scopes_hand_the_state_on(spark, spending):
    base = sinks.scratch_path(spark, "carry-empty")
    for scope, rows in (("2024-12", "false"), ("2025-01", "month = 1"), ("2025-02", "false"), ("2025-03", "month = 3")):
        _sums(base, spending, scope, spending.filter(rows))
    rest = spending.filter("month <> 2")
    before = Window.partitionBy("job").orderBy("month", "day").rowsBetween(Window.unboundedPreceding, -1)
    assert _same(rest.withColumn("running", F.sum("cost").over(before).cast("decimal(38,2)")), carry.read_scopes(spark, base))


@pytest.mark.parametrize("keys", [["job"], []])
def test_fill_goes_on_over_scopes(spark, spending, keys):
    rows = spending.withColumn("tie", F.coalesce("job", F.lit("none")))
    opening, parts = None, []
    for month in (1, 2, 3):
        own = rows.filter(F.col("month") == month)
        parts.append(carry.fill_on(own, "cost", "day", keys, ["tie"], opening, "filled", n_blocks=3))
        opening = sinks.materialize(carry.closing_values(own, "cost", "day", keys, ["tie"], opening), "closing")
    upto = Window.partitionBy(*keys).orderBy("month", "day", "tie").rowsBetween(Window.unboundedPreceding, 0)
    whole = rows.withColumn("filled", F.last("cost", ignorenulls=True).over(upto))
    assert _same(whole, parts[0].unionByName(parts[1]).unionByName(parts[2]))


TEXTS = ["Annual BONUS paid", "benefits and more", "nothing", "", None, "a b", "ab", "xbenefitx", "health\tcare plan",
         "health care plan", "care", "ß STRASSE", "x" * 50_000 + "bonus", "bonus", "bonus", "qualité Été"]


def _flags(spark, texts, listed):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "id int, text string, word string")
    table = spark.createDataFrame([(k,) for k in listed], "keyword string")
    got = keywords.keyword_flags(df, table)
    assert got.columns == ["id", "text", "word", "has_keyword"]
    return {r.id: r.has_keyword for r in got.collect()}, df


def test_keyword_table_equals_the_pattern(spark):
    got, df = _flags(spark, TEXTS, ["bonus", "benefit"])
    assert got == {r.id: r.hit for r in df.select("id", keyword_flag("text", "bonus|benefit").alias("hit")).collect()}


@pytest.mark.parametrize("listed", [["health care"], ["h\tc", "th\tca"], ["A", None, "", "  "], ["ab", "ab", "AB"], ["é"], ["e p"], [],
                                    [None], ["care plan "], [" care"], ["a  b"], ["xx"]])
def test_keywords_of_all_kinds(spark, listed):
    low = [k.lower() for k in listed if k and k.strip()]
    got, _ = _flags(spark, TEXTS, listed)
    assert got == {i: any(k in (t or "").lower() for k in low) for i, t in enumerate(TEXTS)}


def test_keywords_over_no_texts(spark):
    assert _flags(spark, [], ["bonus"])[0] == {}


def test_ten_thousand_keywords(spark):
    rng = random.Random(12)

    def word(low, high):
        return "".join(rng.choices("abcdefghijklmno", k=rng.randint(low, high)))
    listed = [word(3, 7) if rng.random() < 0.8 else f"{word(1, 4)} {word(1, 4)}" for _ in range(10_000)]
    texts = [" ".join(word(1, 9) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    got, df = _flags(spark, texts, listed)
    found = re.compile("|".join(map(re.escape, listed))).search
    assert got == {i: bool(found(t)) for i, t in enumerate(texts)} and len(set(got.values())) == 2
    table = spark.createDataFrame([(k,) for k in listed], "keyword string")
    hits = {(t, r.keyword) for t, r in
            ((t, r) for r in keywords.keyword_hits(df, table).join(df.select(keywords._key("text").alias("text_key"), "text"), "text_key")
             .collect() for t in [r.text])}
    assert hits == {(t, k) for t in texts for k in set(listed) if k in t}
    plan = keywords.keyword_flags(df, table)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_audits_merge_without_the_rows(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("none", F.lit(None).cast("double"))
    # A third of all rows on one day, some without a day.
    day = F.when(F.col("event_id") % 3 == 0, F.lit(0)).when(F.col("event_id") % 10 != 1, (F.col("event_id") % 7).cast("int"))
    events = events.withColumn("day", day)
    days = sinks.materialize(audit_days.daily_audit(events, "day", ["user_id", "props", "none"], ["value", "none"]), "audits")
    assert days.count() == events.select("day").distinct().count()
    got = audit_days.audit_report(audit_days.merge_audits(days), (0.1, 0.5, 0.9)).first()
    rows = events.collect()
    assert got["rows"] == len(rows) and got.null_user_id == sum(r.user_id is None for r in rows)
    assert got.null_none == len(rows) and got.distinct_none == 0 and got.quantiles_none is None
    for c in ("user_id", "props"):
        n = len({r[c] for r in rows if r[c] is not None})
        assert abs(got[f"distinct_{c}"] - n) <= audit_days.DISTINCT_ERROR * n
    values = sorted(r.value for r in rows if r.value is not None)
    for q, x in zip((0.1, 0.5, 0.9), got.quantiles_value, strict=True):
        assert sum(v < x for v in values) / len(values) <= q + audit_days.RANK_ERROR
        assert sum(v <= x for v in values) / len(values) >= q - audit_days.RANK_ERROR
    assert audit_days.daily_audit(events.limit(0), "day", ["user_id"], ["value"]).count() == 0


def test_newest_of_a_search_merge_over_days(spark):
    rng = random.Random(9)
    days = [[(rng.choice(["q", "r", None]), rng.randint(1, 30), rng.randint(0, 99), i) for i in range(d * 100, d * 100 + n)]
            for d, n in enumerate((60, 0, 80, 5))]
    order = [F.col("at").desc_nulls_last(), F.col("i")]
    schema = "search string, ad int, at int, i int"
    kept = spark.createDataFrame([], schema)
    for rows in days:
        kept = sinks.materialize(search.merge_latest(kept, spark.createDataFrame(rows, schema), ["search"], "ad", order, 4), "newest")
    want = set()
    for name in ("q", "r", None):
        best = {}
        for row in sorted((r for d in days for r in d if r[0] == name), key=lambda r: (-r[2], r[3])):
            best.setdefault(row[1], row)
        want |= {(*row, n) for n, row in enumerate(list(best.values())[:4], 1)}
    assert {tuple(r) for r in kept.collect()} == want
