import datetime as dt
import json
from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from conftest import rows
from tidepanel.catalog import QUERIES
from tidepanel.sources import files, raw
from tidepanel.streaming import live


def write(path, doc):
    path.write_text(json.dumps(doc))
    return str(path)


def test_board_with_missing_keys(spark, tmp_path):
    full = {
        "flight": {
            "identification": {"number": {"default": "AB1"}, "callsign": "CS1"},
            "time": {"scheduled": {"arrival": 100, "departure": 50}, "estimated": {"arrival": 110}, "real": {}},
            "airport": {"origin": {"name": "Here", "code": {"iata": "HRE", "icao": "HEEE"}}},
            "aircraft": {"model": {"text": "A320"}, "registration": "R1"},
            "status": {"text": "Landed"},
        }
    }
    bare = {"flight": {"identification": {}, "time": {"scheduled": {"departure": 70}}}}
    board = {"airport": {"pluginData": {"schedule": {"arrivals": {"data": [full, bare]}, "departures": {"data": [bare]}}}}}
    df = files.read_json(spark, write(tmp_path / "board.json", board), raw.BOARD_SCHEMA)
    arr = rows(raw.board_rows(df, "arrivals"), "flight_number")
    assert arr[1]["origin_iata"] == "HRE" and arr[1]["estimated_arrival"] == 110 and arr[1]["real_arrival"] is None
    assert arr[0]["flight_number"] == "" and arr[0]["origin_name"] == "" and arr[0]["scheduled_arrival"] is None
    dep = rows(raw.board_rows(df, "departures"), "flight_number")
    assert len(dep) == 1 and dep[0]["scheduled_departure"] == 70 and dep[0]["dest_iata"] == ""
    empty = {"airport": {"pluginData": {"schedule": {"arrivals": {"data": []}}}}}
    df = files.read_json(spark, write(tmp_path / "empty.json", empty), raw.BOARD_SCHEMA)
    assert raw.board_movements(df).count() == 0


def test_snapshots_weather_states_and_holidays(spark, tmp_path):
    snap = {"timestamp_utc": "2024-01-01T10:00:00+00:00", "flight_count": 2, "flights": [{"id": "a", "latitude": 1.5}, {"id": "b", "altitude": 300}]}
    df = files.read_json(spark, write(tmp_path / "s.json", snap), raw.SNAPSHOT_SCHEMA)
    got = rows(raw.snapshot_rows(df), "id")
    assert got[0]["latitude"] == 1.5 and got[0]["altitude"] is None and got[1]["altitude"] == 300
    assert got[0]["snapshot_ts"] == dt.datetime(2024, 1, 1, 10)

    weather = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.0, None], "weather_code": [3, 65]}}
    df = files.read_json(spark, write(tmp_path / "w.json", weather), raw.WEATHER_SCHEMA)
    got = rows(raw.weather_rows(df), "ts")
    assert [r["temperature_2m"] for r in got] == [1.0, None] and [r["weather_code"] for r in got] == [3, 65]
    assert got[0]["rain"] is None

    states = {"states": [["abc", "X1", "ES", 17, 18, -3.5, 40.5, None, False, 200.0, 90.0, 0, None, 900.0, "7000", False, 0], ["def"]]}
    df = files.read_json(spark, write(tmp_path / "v.json", states), raw.STATES_SCHEMA)
    got = rows(raw.state_rows(df), "icao24")
    assert got[0]["longitude"] == -3.5 and got[0]["on_ground"] is False and got[0]["position_source"] == 0
    assert got[1]["callsign"] is None and got[1]["geo_altitude"] is None

    records = [
        {"date": "2024-01-01", "name": "A", "global": True}, {"date": "2024-02-01", "name": "B", "global": False},
        {"date": "2024-03-01", "name": "C"}, {"date": "2025-01-01", "name": "D", "global": True},
    ]
    df = files.read_json(spark, write(tmp_path / "h.json", records), raw.HOLIDAY_SCHEMA)
    got = raw.national_holidays(df, "2024-01-01", "2024-12-31")
    assert [r["name"] for r in rows(got, "date")] == ["A", "C"]


def test_columns_chunks_and_lookups(spark, tmp_path):
    df = spark.createDataFrame([(1, 2)], "timestamp int, movements int")
    assert files.normalize_columns(df).columns == ["timestamp_hour", "total_movements"]
    both = spark.createDataFrame([(1, 2)], "timestamp int, timestamp_hour int")
    assert files.normalize_columns(both).columns == both.columns
    a, b = spark.createDataFrame([(1, "x")], "k int, a string"), spark.createDataFrame([(2, 5)], "k int, b int")
    assert rows(files.union_chunks([a, b]), "k") == [{"k": 1, "a": "x", "b": None}, {"k": 2, "a": None, "b": 5}]
    assert files.not_landed(a, b, ["k"]).count() == 1
    with pytest.raises(LookupError):
        files.reference_row(a, "k", 9, ("k",))
    with pytest.raises(AnalysisException):
        files.read_parquet(spark, str(tmp_path / "none"))


def test_splits_and_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "train", 0.1), (2, "test", 0.25)], "k int, split string, v double")
    files.write_splits(df, str(tmp_path / "t"))
    one = files.read_parquet(spark, str(tmp_path / "t")).filter("split = 'test'")
    assert rows(one.select("k", "v"), "k") == [{"k": 2, "v": 0.25}]
    assert "PartitionFilters: [isnotnull(split" in one._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    files.write_csv(df, str(tmp_path / "c"))
    assert rows(files.read_csv(spark, str(tmp_path / "c"), df.schema), "k") == rows(df, "k")


def test_stream_takes_new_files_once_and_drops_late_rows(spark, tmp_path):
    src, out, progress = (str(tmp_path / d) for d in ("in", "out", "progress"))
    schema = "event_id long, ts timestamp, user_id long, event_type string"

    def land(data):
        spark.createDataFrame([(i, dt.datetime(2024, 1, 1, h, m), 0, "view") for i, h, m in data], schema).coalesce(1).write.mode("append").parquet(src)

    def run():
        live.run_available(live.hourly_movements(live.event_stream(spark, src)), out, progress)

    land([(1, 1, 5), (2, 1, 50), (3, 2, 10), (4, 5, 0)])
    run()
    first = rows(spark.read.parquet(out), "ts_hour")
    assert [(r["ts_hour"].hour, r["arrivals"]) for r in first] == [(1, 2), (2, 1)]
    land([(5, 1, 55), (6, 9, 0)])  # hour 1 is closed: event 5 comes too late
    run()
    again = rows(spark.read.parquet(out), "ts_hour")
    assert [(r["ts_hour"].hour, r["arrivals"]) for r in again] == [(1, 2), (2, 1), (5, 1)]


def test_stream_dedupe_within_the_delay(spark, tmp_path):
    src, out, progress = (str(tmp_path / d) for d in ("in", "out", "progress"))
    data = [(1, dt.datetime(2024, 1, 1, 1)), (1, dt.datetime(2024, 1, 1, 1)), (2, dt.datetime(2024, 1, 1, 1))]
    spark.createDataFrame(data, "event_id long, ts timestamp").write.parquet(src)
    live.run_available(live.first_seen(live.event_stream(spark, src), "event_id"), out, progress)
    assert sorted(r["event_id"] for r in spark.read.parquet(out).collect()) == [1, 2]
    assert spark.read.parquet(out).filter(F.col("ts").isNull()).count() == 0


def test_bad_records_are_put_aside_with_their_text(spark):
    board = json.dumps({"airport": {"pluginData": {"schedule": {"arrivals": {"data": []}}}}})
    hours = json.dumps({"hourly": {"time": ["2024-01-01T00:00"], "temperature_2m": [1.5]}})
    cases = [
        (1, board, None), (2, board[:-3], "broken"), (3, "<html>busy</html>", "broken"), (4, None, "empty"), (5, " \n", "empty"),
        (6, "{}", "incomplete"), (7, '{"airport": {"pluginData": 3}}', "broken"), (8, board, None), (9, "x" * 200000, "broken"),
    ]
    df = spark.createDataFrame([(i, t, i) for i, t, _ in cases], "id int, body string, airport_id int")
    out = raw.records(df, "body", raw.BOARD_SCHEMA, ["airport.pluginData.schedule"])
    assert {r["id"]: (r["body"], r["reason"]) for r in out.rejected.collect()} == {i: (t, why) for i, t, why in cases if why}
    assert {r["id"] for r in out.valid.collect()} == {1, 8} and out.valid.columns == ["id", "airport_id", "airport"]
    assert {r["reason"]: r["n"] for r in out.counts.collect()} == {"valid": 2, "broken": 4, "empty": 2, "incomplete": 1}
    weather = spark.createDataFrame([(hours,), (hours[:30],)], "body string")
    got = raw.records(weather, "body", raw.WEATHER_SCHEMA, ["hourly.time"])
    assert [r["temperature_2m"] for r in raw.weather_rows(got.valid).collect()] == [1.5] and got.rejected.count() == 1
    none = raw.records(df.limit(0), "body", raw.BOARD_SCHEMA)
    assert none.valid.count() == none.rejected.count() == none.counts.count() == 0


def test_hours_of_odd_line_items(spark, tmp_path):
    """Each document has its hours, over midnight and with missing values; only what differs by the hour is made by the hour."""
    kind = "l_linenumber int, l_quantity double, l_discount double, l_tax double, l_shipdate timestamp_ntz"
    late, day = datetime(1999, 12, 31, 22, 30), datetime(2000, 2, 28)
    given = [(3, 2.5, 0.5, 0.25, late), (2, None, 0.5, 0.25, day), (None, 1.0, 0.5, 0.25, day), (0, 1.0, 0.5, None, day)]
    spark.createDataFrame(given, kind).write.parquet(f"{tmp_path}/lineitem.parquet")
    out = QUERIES["weather_unpack"](spark, str(tmp_path))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("transform(") == 2
    want = [(late + timedelta(hours=i), 150.0 + i, None, 2.5, 5) for i in range(3)]
    want += [(day + timedelta(hours=i), 150.0 + i, 25.0, None, None) for i in range(2)]
    want += [(day - timedelta(hours=i), 150.0 - i, None, 1.0, 2) for i in range(2)]  # a sequence to -1 runs backwards
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
