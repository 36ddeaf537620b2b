import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import alerts
from millrace.plans import QUERIES
from millrace.streaming import streams
from tests.plan_text import planned

SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, value DOUBLE"


def made(n=600, seed=3):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(n):
        user = rng.choice([1, 1, 1, None, 2, 3])
        value = None if rng.random() < 0.05 else round(rng.uniform(80, 100), 1)
        rows.append((i, start + dt.timedelta(seconds=rng.randrange(0, 20) + 13 * i), user, value))
    return rows


def brute(rows, last=10, fall=3.0):
    history, found = {}, set()
    for i, ts, user, value in sorted(rows, key=lambda r: (r[1], r[0])):
        before = [v for v in history.get(user, [])[-(last - 1):] if v is not None]
        if before and value is not None and max(before) - value >= fall:
            found.add((i, user, max(before), value))
        history.setdefault(user, []).append(value)
    return found


@pytest.mark.parametrize("share, slice_rows", [(1e-9, 9), (1e-9, 50), (0.3, 100), (0.3, 10**6), (1.0, 50), (None, 1000)])
def test_drops_equal_brute_force(spark, share, slice_rows):
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA)
    got = alerts.drops(df, "user_id", "ts", "event_id", "value", share=share, slice_rows=slice_rows)
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_drops_on_zoned_timestamps(spark):
    rows = made(100)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))
    got = alerts.drops(df, "user_id", "ts", "event_id", "value", share=1e-9, slice_rows=20)
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_slices_bound_the_groups(spark):
    df = spark.createDataFrame(made(300), SCHEMA)
    with pytest.raises(ValueError):
        alerts.drops(df, "user_id", "ts", "event_id", "value", slice_rows=8)
    burst = df.withColumn("ts", F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))  # one instant
    rows = [(i, dt.datetime(2024, 1, 1), user, value) for i, _, user, value in made(300)]
    got = alerts.drops(burst, "user_id", "ts", "event_id", "value", share=1e-9, slice_rows=10)
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_hot_keys_are_bounded(spark):
    df = spark.createDataFrame([(k,) for k in [1] * 5 + [2] * 4 + [3] * 3 + [4]], "k INT")
    for share in (0.5, 0.3, 0.25, 0.1):
        hot = {r._hot_key for r in alerts.hot_keys(df, "k", share).collect()}
        assert hot == {k for k, n in {1: 5, 2: 4, 3: 3, 4: 1}.items() if n >= share * 13} and len(hot) <= 1 / share


def parts(spark, path, frames):
    """One file after another, so that a paced stream reads them in this order."""
    import os
    import time

    for i, rows in enumerate(frames):
        name = f"{path}/part-{i}"
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(name)
        for f in os.listdir(name):
            if f.startswith("part-"):
                stamp = time.time() - 1000 + 10 * i
                os.utime(f"{name}/{f}", (stamp, stamp))
    return f"{path}/*"


def test_stream_drops_over_several_batches(spark, tmp_path):
    rows = [r for r in made(200) if r[2] is not None]
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    src = parts(spark, str(tmp_path / "in"), [ordered[:60], ordered[60:70], ordered[70:]])
    stream = streams.stream_files(spark, src, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)
    query = streams.stream_drops(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "user_id", "ts", "event_id", "value")
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    got = {tuple(r) for r in streams.stream_alerts(spark, str(tmp_path / "out")).collect()}
    assert got == brute(rows)
    carried = sorted(p.name for p in (tmp_path / "out" / "carry").iterdir())
    assert carried == ["batch_id=1", "batch_id=2"]  # what a batch that runs again needs, and no more


NAMES = ("user_id", "ts", "event_id", "value")


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    rows = sorted(made(300), key=lambda r: (r[1], r[0]))
    out = str(tmp_path / "out")
    for n, part in ((0, rows[:100]), (1, rows[100:140]), (1, rows[100:140]), (2, rows[140:]), (2, rows[140:])):
        streams.drop_batch(spark.createDataFrame(part, SCHEMA), n, out, *NAMES)
        seen = rows[: rows.index(part[-1]) + 1]
        assert {tuple(r) for r in streams.stream_alerts(spark, out).collect()} == brute(seen)


def test_a_hot_entity_over_batches_is_cut_into_slices(spark, tmp_path):
    rows = [(i, ts, 1, value) for i, ts, _, value in made(400)]
    rows.sort(key=lambda r: (r[1], r[0]))
    for n in range(4):
        part = spark.createDataFrame(rows[100 * n : 100 * n + 100], SCHEMA)
        streams.drop_batch(part, n, str(tmp_path / "out"), *NAMES, share=0.1, slice_rows=30)
    assert {tuple(r) for r in streams.stream_alerts(spark, str(tmp_path / "out")).collect()} == brute(rows)


def brute_within(rows, seconds, last=10, fall=3.0):
    history, found = {}, set()
    for i, ts, user, value in sorted(rows, key=lambda r: (r[1], r[0])):
        near = [v for t, v in history.get(user, [])[-(last - 1):] if v is not None and (ts - t).total_seconds() <= seconds]
        if near and value is not None and max(near) - value >= fall:
            found.add((i, user, max(near), value))
        history.setdefault(user, []).append((ts, value))
    return found


def test_silent_entities_expire(spark, tmp_path):
    rows = sorted(made(300), key=lambda r: (r[1], r[0]))
    want = brute_within(rows, 60)
    assert want and want != brute(rows)
    whole = alerts.drops(spark.createDataFrame(rows, SCHEMA), *NAMES, within="60 seconds")
    assert {tuple(r) for r in whole.collect()} == want
    quiet = [(1000 + i, rows[0][1], 77, 99.0) for i in range(3)]  # an entity seen in the first batch only
    out = str(tmp_path / "out")
    for n, part in enumerate((quiet + rows[:150], rows[150:160], rows[160:])):
        streams.drop_batch(spark.createDataFrame(part, SCHEMA), n, out, *NAMES, within="60 seconds")
        carried = {r.user_id for r in spark.read.parquet(f"{out}/carry/batch_id={n}").collect()}
        assert 77 not in carried and carried
    assert {tuple(r) for r in streams.stream_alerts(spark, out).collect()} == want


def test_batches_of_alerts_use_no_python_groups(spark):
    found = alerts.drops(spark.createDataFrame(made(50), SCHEMA), *NAMES, within="1 day")
    assert "InPandas" not in planned(found) and "ArrowEval" not in planned(found)


def test_pacing(spark, tmp_path):
    src = parts(spark, str(tmp_path / "in"), [[r] for r in made(5)])
    stream = streams.stream_files(spark, src, spark.createDataFrame([], SCHEMA).schema, files_per_batch=2)
    query = streams.append_to(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [2, 2, 1]


def test_late_rows_are_dropped(spark, tmp_path):
    def row(i, hour, minute=0):
        return (i, dt.datetime(2024, 1, 1, hour, minute), 1, 1.0)

    batches = [[row(0, 1), row(1, 1, 30)], [row(2, 9)], [row(6, 9, 10)], [row(3, 1, 45), row(4, 9, 30)], [row(5, 20)]]
    src = parts(spark, str(tmp_path / "in"), batches)
    stream = streams.stream_files(spark, src, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)
    hours = streams.hourly(stream, "ts", "user_id", "1 hour")
    run = streams.append_to(hours, str(tmp_path / "out"), str(tmp_path / "cp"))
    run.awaitTermination()
    assert streams.late_groups(run) == (7, 1)
    got = {(r.window_start.hour, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {(1, 2), (9, 3)}  # the row of 1:45 came after the watermark, the hour of 20:00 is still open


def test_running_totals_survive_a_restart(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    cuts = [0, 10, 12, 15, 20, 25]
    for a, b in zip(cuts, cuts[1:]):
        rows = made(25)[a:b]
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(str(tmp_path / "in"))
        totals = streams.type_counts(streams.stream_files(spark, str(tmp_path / "in"), schema), "user_id")
        streams.publish_totals(totals, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    want = pd.Series([r[2] for r in made(25)]).value_counts(dropna=False)
    kept = sorted(int(p.name.partition("=")[2]) for p in (tmp_path / "out" / "totals").iterdir())
    assert kept == list(range(kept[-1] - 2, kept[-1] + 1))  # older totals are gone
    got = {r.user_id: r.n for r in streams.latest_totals(spark, str(tmp_path / "out")).collect()}
    assert sum(got.values()) == 25 and got[1] == want[1.0]


def test_alert_query_looks_back_as_far_as_an_entity_has_rows(spark, tmp_path):
    """A fall against a row of weeks ago, carried over two runs."""
    rows = [(1, dt.datetime(2024, 1, 2), 7, 9.0), (2, dt.datetime(2024, 1, 29), 7, 1.0), (3, dt.datetime(2024, 1, 15), 8, 1.0)]
    spark.createDataFrame(rows, "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, value DOUBLE").write.parquet(str(tmp_path / "events.parquet"))
    assert [tuple(r) for r in QUERIES["stream_alert"](spark, str(tmp_path)).collect()] == [(2, 7, 9.0, 1.0)]
