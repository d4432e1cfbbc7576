"""Streams without rows to hand on, and batches of a feed whose alerts fill many files."""

from datetime import datetime, timedelta
from glob import glob

import pytest

from pylonflow.plans.catalog import QUERIES, STREAM_FILES
from pylonflow.session import checkpoint_root

T0 = datetime(2024, 1, 1)
EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def events(spark, path, rows, files=1):
    spark.createDataFrame(rows, EVENTS).repartition(files).write.parquet(f"{path}/events.parquet")
    return str(path)


@pytest.mark.parametrize("rows", [0, 40])
def test_a_stream_that_finds_nothing_is_an_empty_table(spark, tmp_path, rows):
    # warm, but not so hot that an alert is escalated; no rows at all
    warm = [(i, T0 + timedelta(hours=i), i, "view", 230.0, '{"k": 10}') for i in range(rows)]
    got = QUERIES["stream_runbook_feed"](spark, events(spark, tmp_path, warm))
    assert got.count() == 0 and got.columns[:2] == ["tower_id", "tower_name"] and "severity_level" in got.columns


def test_the_feeds_batches_do_not_grow_with_the_files_of_its_alerts(spark, tmp_path):
    hot = [(i, T0 + timedelta(hours=i), i, ["view", "click"][i % 2], 290.0, '{"k": 99}') for i in range(200)]
    commits = f"{checkpoint_root(spark).removeprefix('file:')}/pylonflow/alert_feed/*/checkpoint/commits/[0-9]*"
    before = set(glob(commits))
    got = QUERIES["stream_alert_feed"](spark, events(spark, tmp_path, hot))
    assert got.count() == 50 and 1 < len(set(glob(commits)) - before) <= STREAM_FILES
