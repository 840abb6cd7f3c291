"""A feature table kept up to date by chunks equals one built at once, and reads and writes what a chunk touches only."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tidepanel.config import Settings
from tidepanel.operators import panel, target, windows
from tidepanel.plans.incremental import FeatureTable

SMALL = Settings(daily_lags=(1, 3, 7), daily_exempt_lags=(7,), daily_mean_windows=(3, 5), daily_std_windows=(5,), year_lag=10)
DAY = dt.date(2024, 1, 1)
SCHEMA = "entity int, dt date, arrivals long, departures long"


def chunk(spark, rows):
    return spark.createDataFrame([(e, None if d is None else DAY + dt.timedelta(d), a, b) for e, d, a, b in rows], SCHEMA)


def at_once(counts, model):
    whole = target.score_by(target.with_phase(panel.fill_gaps(counts, ["entity"], "dt", "day"), "dt"), model, target.DAILY_PHASE, settings=SMALL)
    return windows.daily_window_features(whole, SMALL)


def made(df, columns):
    return {(r["entity"], r["dt"]): r.asDict() for r in df.select("entity", "dt", *columns).collect()}


def fitted(spark, tmp_path, counts):
    scored = target.with_phase(panel.fill_gaps(counts, ["entity"], "dt", "day"), "dt")
    model = target.score_model(target.score_table(scored, target.DAILY_PHASE), target.DAILY_PHASE)
    model.write.parquet(str(tmp_path / "model"))
    table = FeatureTable(spark, str(tmp_path / "table"), SMALL, block_days=16, buckets=3)
    model = spark.read.parquet(str(tmp_path / "model"))
    table.create(model)
    return table, model


def test_chunks_equal_a_full_build(spark, tmp_path):
    truth = {(e, d): ((d * 7 + e * 3) % 11, (d * 5 + e) % 6) for e in range(4) for d in range(20, 120) if (d + e) % 9}
    first = [(e, d, a, b) for (e, d), (a, b) in truth.items() if e < 3 and 40 <= d < 70 and d % 5]
    table, model = fitted(spark, tmp_path, chunk(spark, [(e, d, a, b) for (e, d), (a, b) in truth.items()]))
    columns = ["arrivals", "departures", "total_movements", "acps", *table.columns]
    held = {}
    chunks = [
        first,
        [(0, 110, 4, 1), (1, 55, 9, 9)],  # a jump over days without counts, and a day that changes
        [(e, d, a, b) for (e, d), (a, b) in truth.items() if (e, d, a, b) not in first],  # earlier days, late ones, a new entity
        [(0, 110, *truth[0, 110]), (1, 55, *truth.get((1, 55), (0, 0)))],
        [(None, 1, 1, 1), (2, None, 1, 1)],  # nothing to land
    ]
    for n, rows in enumerate(chunks, 1):
        table.land(chunk(spark, rows), n)
        held |= {(e, d): (a, b) for e, d, a, b in rows if e is not None and d is not None}
        want = made(at_once(chunk(spark, [(*k, *v) for k, v in held.items()]), model), columns)
        assert made(table.features(), columns) == want, n
    for n in (3, 2):  # landing again, out of order too, changes nothing
        table.land(chunk(spark, chunks[n - 1]), n)
        assert made(table.features(), columns) == want


def test_repeated_rows_add_up_and_unknown_phases_have_no_score(spark, tmp_path):
    table, _ = fitted(spark, tmp_path, chunk(spark, [(0, d, d, 1) for d in range(3)]))
    table.land(chunk(spark, [(0, 0, 1, None), (0, 0, 2, 1), (0, 4, 5, 5)]), 1)
    got = {(r["dt"] - DAY).days: (r["arrivals"], r["departures"], r["acps"] is None) for r in table.features().collect()}
    assert got == {0: (3, 1, False), 1: (0, 0, False), 2: (0, 0, False), 3: (0, 0, True), 4: (5, 5, True)}


def test_only_touched_partitions_are_read_and_written(spark, tmp_path):
    rows = [(e, d, d % 5, 1) for e in range(9) for d in range(200)]
    table, _ = fitted(spark, tmp_path, chunk(spark, rows))
    table.land(chunk(spark, rows), 1)

    def files():
        return {os.path.join(at, f) for at, _, names in os.walk(f"{table.path}/features") for f in names if f.endswith(".parquet")}

    before = files()
    table.land(chunk(spark, [(4, 100, 50, 50)]), 2)
    changed = {tuple(f.split("/")[-3:-1]) for f in before ^ files()}
    touched = table.touched(2)
    block, bucket = (DAY + dt.timedelta(100) - dt.date(1970, 1, 1)).days // 16, touched.first()["bucket"]
    assert changed == {(f"block={b}", f"bucket={bucket}") for b in (block, (DAY + dt.timedelta(110) - dt.date(1970, 1, 1)).days // 16)}
    read = table._read("counts", "entity int, dt date, arrivals long, departures long, chunk long, block int, bucket int").where(table.halo_partitions(touched))
    parts = {(r["block"], r["bucket"]) for r in read.select(F.col("block"), F.col("bucket")).distinct().collect()}
    assert {k for _, k in parts} == {bucket} and {b for b, _ in parts} == set(range(block - 1, max(int(c[0].split("=")[1]) for c in changed) + 1))
    scan = next(line for line in read._jdf.queryExecution().toString().splitlines() if "FileScan" in line)
    assert "PartitionFilters: [" in scan and "block" in scan.split("PartitionFilters: [")[1]
