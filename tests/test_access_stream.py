"""Marts from the stream equal the batch marts, with late, repeated and restarted input."""

import random
from collections import Counter

import pytest

from shopmarts.operators import marts, silver
from shopmarts.sources.schemas import ACCESS_LOGS
from shopmarts.streaming.access import AccessStream
from tests.fixtures import access, raw_frames


def events(n=120, seed=1):
    rng = random.Random(seed)
    return [access(i, rng.choice([None, 1, 2, 3]), ts=f"2025-03-{1 + i // 10:02d} {rng.randint(0, 23):02d}:00:00",
                   ip=rng.choice([None, "10.0.0.1", "10.0.0.2"]), success=rng.choice([0, 1]),
                   threat=rng.choice(["normal", "bot", "fraud"])) for i in range(n)]


def land(spark, folder, rows):
    spark.createDataFrame(rows, ACCESS_LOGS).coalesce(1).write.mode("append").parquet(folder)


def same(spark, stream, rows):
    log = silver.all_silver(raw_frames(spark, access_logs=rows))["access_logs"]
    for got, want in ((stream.access_summary(), marts.access_summary(log)),
                      (stream.threat_events(), marts.threat_events(log))):
        assert got.dtypes == want.dtypes
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect()))


@pytest.fixture
def stream(spark, tmp_path):
    return AccessStream(spark, f"{tmp_path}/in", ACCESS_LOGS, f"{tmp_path}/out", files_per_trigger=1)


def test_late_repeated_and_restarted_input(spark, tmp_path, stream):
    rows = events()
    order = rows[:40] + rows[60:90]                     # 40-59 come late, within the delay
    land(spark, stream.source, order)
    land(spark, stream.source, rows[40:60] + rows[30:70])      # with events seen before
    stream.catch_up()
    same(spark, stream, rows[:90])
    # a new process goes on from the checkpoint: nothing is counted again
    again = AccessStream(spark, stream.source, ACCESS_LOGS, f"{tmp_path}/out", files_per_trigger=1)
    again.catch_up()
    land(spark, stream.source, rows[90:] + rows[85:95] + rows[110:])
    again.catch_up()
    same(spark, again, rows)


def test_events_beyond_the_delay_are_left_out(spark, stream):
    rows = events()
    land(spark, stream.source, rows)
    stream.catch_up()
    land(spark, stream.source, [access(900, 1, ts="2025-01-01 10:00:00"), access(901, 1, ts="2025-03-12 10:00:00")])
    stream.catch_up()
    same(spark, stream, rows + [access(901, 1, ts="2025-03-12 10:00:00")])


def test_a_micro_batch_that_runs_again_replaces_itself(spark, stream):
    rows = events(40)
    log = silver.all_silver(raw_frames(spark, access_logs=rows))["access_logs"]
    stream.add_batch(log.limit(7), 0)                   # a failed first try
    stream.add_batch(log, 0)
    same(spark, stream, rows)
