"""Streams that correct themselves: replayed batches, late rows, latest states."""

import datetime as dt

from conftest import rows
from tidepanel.streaming import keyed, live

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double"


def at(h, m=0):
    return dt.datetime(2024, 1, 1, h, m)


def land(spark, path, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_hours_are_corrected_and_replays_change_nothing(spark, tmp_path):
    src, out, progress, small = (str(tmp_path / d) for d in ("in", "out", "progress", "small"))

    def run():
        keyed.revise_hours(live.event_stream(spark, src), out, progress)
        return [(r["ts_hour"].hour, r["arrivals"], r["departures"]) for r in rows(keyed.revised_hours(spark, out), "ts_hour")]

    land(spark, src, [(1, at(1, 5), 0, "view", 1.0), (2, at(1, 50), 0, "purchase", 1.0), (3, at(9), 0, "view", 1.0), (4, None, 0, "view", 1.0)])
    assert run() == [(1, 1, 1), (9, 1, 0)]
    land(spark, src, [(5, at(1, 55), 0, "view", 1.0), (6, at(3), 5, "signup", None)])  # hours that were sent before
    assert run() == [(1, 2, 1), (3, 0, 1), (9, 1, 0)]
    assert run() == [(1, 2, 1), (3, 0, 1), (9, 1, 0)]
    # a batch that is tried again
    events = spark.read.parquet(src).where("event_id IN (5, 6)")
    for _ in range(2):
        keyed.write_hours(out)(keyed.hourly_changes(events), 1)
    assert [r["arrivals"] for r in rows(keyed.revised_hours(spark, out), "ts_hour")] == [2, 0, 1]
    keyed.compact(spark, out, small)
    assert rows(keyed.revised_hours(spark, small), "ts_hour") == rows(keyed.revised_hours(spark, out), "ts_hour")


def test_latest_state_over_polls(spark, tmp_path):
    src, out, progress = (str(tmp_path / d) for d in ("in", "out", "progress"))

    def run():
        polls = live.event_stream(spark, src)
        states = keyed.latest_states(polls, "user_id", "ts", "event_id", ["event_type", "value"], "2 hours", 3_600_000)
        keyed.run_batches(states, out, progress, "update")
        found = keyed.current(keyed.batches(spark, out, states.schema), "user_id")
        return {r["user_id"]: (r["ts"].hour, r["event_type"], r["value"], r["n_polls"], r["n_changes"]) for r in found.collect()}

    land(spark, src, [(1, at(10), 7, "scheduled", 100.0), (2, at(10), 8, "scheduled", None)])
    assert run() == {7: (10, "scheduled", 100.0, 1, 0), 8: (10, "scheduled", None, 1, 0)}
    land(spark, src, [(3, at(11), 7, "estimated", 130.0), (4, at(11), 8, "scheduled", None)])
    assert run() == {7: (11, "estimated", 130.0, 2, 1), 8: (11, "scheduled", None, 2, 0)}
    land(spark, src, [(5, at(10, 30), 7, "estimated", 115.0)])  # an older poll, late but within the delay
    assert run()[7] == (11, "estimated", 130.0, 3, 1)
    land(spark, src, [(6, at(23), 9, "landed", 1.0)])
    assert run()[9] == (23, "landed", 1.0, 1, 0)
