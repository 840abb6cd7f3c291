import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from conftest import rows
from tidepanel.functions import calendar as cal
from tidepanel.functions import spatial
from tidepanel.functions import weather as wx
from tidepanel.operators import panel, windows


def hours(spark, data):
    df = spark.createDataFrame(data, "entity int, h int, n long")
    return df.select("entity", (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_interval(hours="h")).alias("ts_hour"), "n")


def test_one_sided_hours_and_gaps_count_zero(spark):
    arr = hours(spark, [(0, 0, 2), (0, 5, 1), (1, 3, 4)]).withColumnRenamed("n", "arrivals")
    dep = hours(spark, [(0, 5, 3), (0, 7, 1)]).withColumnRenamed("n", "departures")
    keys = ["entity", "ts_hour"]
    stacked, joined = panel.combine_counts(arr, dep, keys), panel.outer_join_counts(arr, dep, keys)
    assert rows(stacked, *keys) == rows(joined.select(stacked.columns), *keys)
    full = rows(panel.fill_gaps(stacked, ["entity"], "ts_hour", "hour"), "entity", "pos")
    zero = [r for r in full if r["entity"] == 0]
    assert [r["total_movements"] for r in zero] == [2, 0, 0, 0, 0, 4, 0, 1]
    assert {r["n_steps"] for r in zero} == {8} and [r["pos"] for r in zero] == list(range(8))
    missing = panel.missing_steps(stacked, ["entity"], "ts_hour", "hour")
    assert missing.count() == 5


def test_null_times_are_not_counted(spark):
    df = spark.createDataFrame([(0, 10), (0, 3700), (0, None)], "entity int, t long")
    out = panel.hourly_counts(df, ["entity"], cal.from_unix(F.col("t")), "n")
    assert sorted(r["n"] for r in out.collect()) == [1, 1]


def test_holiday_neighbours_and_bridge_days(spark):
    # Thu 2024-08-15, Tue 2024-10-01, Sat 2024-10-12, Mon 2024-12-02 and Wed 2024-12-04
    marked = ["2024-08-15", "2024-10-01", "2024-10-12", "2024-12-02", "2024-12-04"]
    holidays = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in marked], "date date")
    days = pd.date_range("2024-08-01", "2024-12-31").date
    df = spark.createDataFrame([(d,) for d in days], "dt date")
    got = {r["dt"]: r for r in cal.holiday_flags(df, holidays, "dt").collect()}
    off = {dt.date.fromisoformat(d) for d in marked}
    one = dt.timedelta(days=1)
    for d in days:
        r = got[d]
        assert r["is_holiday"] == (d in off)
        assert r["is_pre_holiday"] == (d + one in off)
        assert r["is_post_holiday"] == (d - one in off)
        free = lambda x: x in off or x.weekday() >= 5
        assert r["is_bridge_day"] == (not free(d) and free(d - one) and free(d + one))
    bridges = {d for d, r in got.items() if r["is_bridge_day"]}
    assert bridges == {dt.date(2024, 8, 16), dt.date(2024, 9, 30), dt.date(2024, 12, 3)}


def test_weather_flags_with_nulls_and_bin_edges(spark):
    data = [(10.0, 65, 0.1), (30.0, 64, 0.0), (50.0, None, None), (9.9, 95, 1.0), (None, 0, 0.0)]
    df = spark.createDataFrame(data, "wind_speed_10m double, weather_code int, rain double").withColumn(
        "wind_direction_10m", F.lit(90.0)
    )
    out = wx.weather_features(df).collect()
    assert [r["wind_bucket"] for r in out] == ["moderate", "strong", "severe", "calm", None]
    assert [r["is_severe_weather"] for r in out] == [True, False, False, True, False]
    assert [r["is_raining"] for r in out] == [True, False, False, True, False]
    assert abs(out[0]["wind_dir_sin"] - 1) < 1e-12


def test_first_reading_of_an_hour_is_kept(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 9, "z")], "ts int, seq int, v string")
    out = windows.first_per_key(df, ["ts"], ["seq"], ["v"])
    assert rows(out, "ts") == [{"ts": 1, "v": "a"}, {"ts": 2, "v": "z"}]


def test_distance_and_bands(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 0.0)], "latitude double, longitude double")
    nm = [r[0] for r in df.select(spatial.haversine_nm(0.0, 0.0, F.col("latitude"), F.col("longitude"))).collect()]
    assert nm[0] == 0 and abs(nm[1] - 60.04) < 0.01 and abs(nm[1] - nm[2]) < 1e-9
    km = spark.createDataFrame([(0.0,), (15.0,), (39.9,), (80.0,), (None,)], "km double")
    bands = spatial.DEFAULTS.bands_km
    got = [r[0] for r in km.select(spatial.band_label(F.col("km") / spatial.KM_PER_NM, bands)).collect()]
    assert got == ["inner", "middle", "middle", "outside", None]


def test_spine_of_a_far_range_is_dealt_in_blocks(spark):
    """From 1970 to the year 9999: 70 million hours, counted without an array of them."""
    ends = [(0, "1970-01-01 00:00:00"), (0, "9999-12-31 23:00:00"), (1, "2024-02-28 23:00:00"), (1, "2024-03-01 01:00:00"), (2, None)]
    df = spark.createDataFrame(ends, "entity int, t string").select("entity", F.col("t").cast("timestamp").alias("t"))
    spine = panel.time_spine(df, ["entity"], "t", "hour")
    far = spine.where("entity = 0").agg(F.count("*"), F.min("t"), F.max("pos"), F.max("n_steps"), F.max(F.unix_micros("t"))).first()
    n = 70389528
    assert (far[0], far[2], far[3], far[4]) == (n, n - 1, n, (n - 1) * 3_600_000_000)
    near = spine.where("entity = 1").orderBy("pos").collect()
    assert [r["pos"] for r in near] == list(range(27)) and str(near[1]["t"]) == "2024-02-29 00:00:00" and near[0]["n_steps"] == 27
    assert spine.where("entity = 2").isEmpty()
    days = panel.time_spine(df.select("entity", F.to_date("t").alias("t")), ["entity"], "t", "day").where("entity = 1").orderBy("pos").collect()
    assert [str(r["t"]) for r in days] == ["2024-02-28", "2024-02-29", "2024-03-01"]


def test_reports_meet_all_centres_in_reach(spark):
    """Against all pairs: near the date line, near a pole, with equal places and places off the globe."""
    import math
    import random

    rng = random.Random(4)
    places = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(150)]
    places += [(rng.uniform(-1, 1), rng.choice([-180, 180]) * rng.uniform(0.995, 1)) for _ in range(60)]
    places += [(rng.choice([-1, 1]) * rng.uniform(88, 90), rng.uniform(-180, 180)) for _ in range(60)]
    places += [(40 + rng.uniform(-1, 1), -3.5 + rng.uniform(-1, 1)) for _ in range(100)] + [(90.0, 0.0), (-90.0, 5.0), (0.0, 180.0), (0.0, -180.0)]
    centres = [(i, *places[i * 3]) for i in range(100)] + [(1000, None, 1.0), (1001, 91.0, 1.0)]
    reports = spark.createDataFrame([(i, *p) for i, p in enumerate(places)] + [(9999, None, 0.0)], "id int, latitude double, longitude double")
    found = spatial.near_centres(reports, spark.createDataFrame(centres, "centre int, centre_lat double, centre_lon double"))
    outer = max(b[2] for b in spatial.DEFAULTS.bands_km)

    def km(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return 2 * spatial.EARTH_RADIUS_NM * spatial.KM_PER_NM * math.asin(math.sqrt(min(1, h)))

    want = {(i, c[0]) for i, p in enumerate(places) for c in centres[:100] if km(c[1], c[2], *p) < outer}
    got = [(r["id"], r["centre"]) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 300
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()


def test_hexagons_are_the_nearest_ones(spark):
    import random

    rng = random.Random(2)
    points = [(rng.uniform(-3, 3), rng.uniform(-3, 3)) for _ in range(200)]
    df = spark.createDataFrame([(y, x, 1.0) for x, y in points], "latitude double, longitude double, altitude double")
    got = {(r["hex_q"], r["hex_r"]): r["n"] for r in spatial.hex_grid(df, 0.5).collect()}
    want = {}
    for x, y in points:
        middle = lambda h: (0.5 * 3**0.5 * (h[0] + h[1] / 2), 0.75 * h[1])
        best = min(((q, r) for q in range(-12, 13) for r in range(-8, 9)), key=lambda h: (middle(h)[0] - x) ** 2 + (middle(h)[1] - y) ** 2)
        want[best] = want.get(best, 0) + 1
    assert got == want
