"""Randomised properties (hypothesis) of the operators that replace
single-task windows and arbitrary dedup."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adpulse.operators import clean
from adpulse.operators.numbering import global_rank

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(-50, 50)),
                min_size=1, max_size=60, unique=True)


@SETTINGS
@given(keys, st.integers(1, 9))
def test_global_rank_is_row_number(spark, ks, parts):
    df = spark.createDataFrame(ks, "c string, n int")
    got = {(r.c, r.n): r.rank for r in global_rank(df, ["c", "n"], num_partitions=parts).collect()}
    ordered = sorted(ks, key=lambda k: (k[0] is not None, k[0] or "", k[1]))
    assert got == {k: i + 1 for i, k in enumerate(ordered)}


rows = st.lists(st.tuples(st.sampled_from(["x", "y", None]),
                          st.one_of(st.none(), st.integers(0, 5)),
                          st.integers(0, 3)), min_size=1, max_size=40)


@SETTINGS
@given(rows)
def test_dedup_picks_greatest_row(spark, rs):
    df = spark.createDataFrame(rs, "id string, t int, v int")
    got = sorted(((r.id or ""), r.t, r.v) for r in clean.dedup_latest(df, "id", ("t",)).collect())
    best = {}
    for i, t, v in rs:
        # greatest (t, v) with nulls lowest
        cand = (t is not None, t if t is not None else 0, v)
        if i not in best or cand > best[i][0]:
            best[i] = (cand, t, v)
    assert got == sorted(((i or ""), t, v) for i, (_, t, v) in best.items())


fills = st.lists(st.tuples(st.sampled_from(["g", "h"]), st.one_of(st.none(), st.integers(0, 99))),
                 min_size=1, max_size=80)


@SETTINGS
@given(fills, st.integers(1, 12))
def test_forward_fill_is_last_non_null(spark, fs, n_blocks):
    base = dt.datetime(2024, 1, 1)
    data = [(i, g, base + dt.timedelta(hours=3 * i), v) for i, (g, v) in enumerate(fs)]
    df = spark.createDataFrame(data, "k long, g string, t timestamp, v long")
    got = {r.k: r.v for r in clean.forward_fill(df, "v", "t", ["g"], n_blocks=n_blocks).collect()}
    last, want = {}, {}
    for k, g, _, v in data:
        if v is not None:
            last[g] = v
        want[k] = last.get(g)
    assert got == want


def _hav_km(lon1, lat1, lon2, lat2):
    import math
    p1, p2 = math.radians(lat1), math.radians(lat2)
    h = (math.sin((p2 - p1) / 2) ** 2
         + math.cos(p1) * math.cos(p2) * math.sin((math.radians(lon2) - math.radians(lon1)) / 2) ** 2)
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, h)))


coords = st.tuples(st.floats(-180, 179.999), st.floats(-88, 88))


@SETTINGS
@given(st.lists(coords, min_size=1, max_size=40), st.lists(coords, min_size=1, max_size=25),
       st.sampled_from([20.0, 80.0, 300.0]))
def test_nearest_place_equals_brute_force_everywhere(spark, places, points, max_km):
    from adpulse.operators import geo
    pl = spark.createDataFrame([(lo, la, f"p{i}", "c", "s", "x") for i, (lo, la) in enumerate(places)],
                               "longitude double, latitude double, city string, county string, state string, country string")
    pts = spark.createDataFrame([(i, lo, la) for i, (lo, la) in enumerate(points)],
                                "point_id long, longitude double, latitude double")
    got = {r.point_id: r.distance_km for r in geo.reverse_geocode(pts, pl, max_km=max_km).collect()}
    for i, (lo, la) in enumerate(points):
        best = min(_hav_km(lo, la, plo, pla) for plo, pla in places)
        if best <= max_km - 1e-6:
            assert got[i] is not None and abs(got[i] - best) < 1e-6
        elif best > max_km + 1e-6:
            assert got[i] is None


anywhere = st.tuples(st.one_of(st.floats(-180, 180), st.sampled_from([-180.0, 180.0, 0.0, 45.0])),
                     st.one_of(st.floats(-90, 90), st.sampled_from([-90.0, 90.0, 89.9999, 45.0, 0.0])))


@SETTINGS
@given(st.lists(anywhere, min_size=1, max_size=30), st.lists(anywhere, min_size=1, max_size=25))
def test_nearest_place_equals_brute_force_at_any_distance(spark, places, points):
    """Also at the poles, on cell borders and across the date line."""
    from adpulse.operators import geo
    pl = spark.createDataFrame([(lo, la, f"p{i}", "c", "s", "x") for i, (lo, la) in enumerate(places)],
                               "longitude double, latitude double, city string, county string, state string, country string")
    pts = spark.createDataFrame([(i, lo, la) for i, (lo, la) in enumerate(points)],
                                "point_id long, longitude double, latitude double")
    got = {r.point_id: r.distance_km for r in geo.reverse_geocode(pts, pl).collect()}
    for i, (lo, la) in enumerate(points):
        assert abs(got[i] - min(_hav_km(lo, la, plo, pla) for plo, pla in places)) < 1e-5


ads_rows = st.lists(st.tuples(st.sampled_from(["Acme", "Bolt", "Core", None]),
                              st.sampled_from(["CA", "TX", None]),
                              st.sampled_from([0.25, 1.0, 3.5, 6.25])),
                    min_size=1, max_size=30)


@SETTINGS
@given(ads_rows)
def test_campaigns_rerun_is_stable_and_ids_contiguous(spark, rows):
    from adpulse.operators.campaigns import campaigns_incremental
    from adpulse.schemas import CAMPAIGN_SCHEMA

    ads = spark.createDataFrame(rows, "company_name string, state string, bid double")
    first = sorted(campaigns_incremental(None, ads).collect())
    keys = {(c, s) for c, s, _ in rows if c is not None}
    assert len(first) == len(keys) == len({(r.company_name, r.state) for r in first})
    assert sorted(r.campaign_id for r in first) == list(range(1001, 1001 + len(keys)))
    again = campaigns_incremental(spark.createDataFrame(first, CAMPAIGN_SCHEMA), ads).collect()
    assert sorted(again) == first
