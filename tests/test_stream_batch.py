"""Randomised stream == batch: readings split over several files in
event-time order (an append-only stream; out-of-order files would make later
rows late, which Spark drops by design), plus a sentinel reading far in the
future that closes every window."""

import random
from datetime import datetime, timedelta

import pytest

from pylonflow import TELEMETRY, detect_alerts, red_episodes
from pylonflow.operators.episodes import red_episodes_stream
from pylonflow.schemas import ALERT
from pylonflow.streaming.flows import Sink, run_to_sink

T0 = datetime(2024, 3, 1)


def _readings(seed, n):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        tower = f"TWR-{rnd.randint(1, 4):03d}"
        hot = rnd.random() < 0.3
        rows.append((tower, tower.lower(), 40.0, -3.0, rnd.uniform(86, 95) if hot else rnd.uniform(60, 84),
                     rnd.uniform(-100, -91) if hot and rnd.random() < 0.5 else rnd.uniform(-89, -65), 50.0,
                     T0 + timedelta(milliseconds=rnd.randint(0, 900_000)), hot))
    return rows


def _key(rows):
    return sorted((r.tower_id, r.window_start, r.event_count, round(r.avg_temperature, 9)) for r in rows)


@pytest.mark.parametrize("seed,n_files", [(1, 2), (7, 3), (42, 4)])
def test_stream_alerts_equal_batch(spark, tmp_path_factory, seed, n_files):
    d = str(tmp_path_factory.mktemp("sb"))
    rows = sorted(_readings(seed, 600), key=lambda r: r[7])
    size = -(-len(rows) // n_files)
    for i in range(n_files):   # consecutive time ranges, shuffled inside each file
        chunk = rows[i * size:(i + 1) * size]
        random.Random(seed + i).shuffle(chunk)
        spark.createDataFrame(chunk, TELEMETRY).coalesce(1).write.parquet(f"{d}/in/f{i}")
    sentinel = [("TWR-001", "twr-001", 40.0, -3.0, 60.0, -70.0, 50.0, T0 + timedelta(days=1), False)]
    spark.createDataFrame(sentinel, TELEMETRY).write.parquet(f"{d}/in/zz")
    stream = spark.readStream.schema(TELEMETRY).option("maxFilesPerTrigger", "1").parquet(f"{d}/in/*")
    got = run_to_sink(detect_alerts(stream, watermark="10 seconds"), Sink(f"{d}/out", f"{d}/ck"))
    assert _key(got.collect()) == _key(detect_alerts(spark.createDataFrame(rows, TELEMETRY)).collect())

    # episodes: session-window stream over the alert table == batch episodes
    alerts_in = spark.readStream.schema(ALERT).parquet(f"{d}/out")
    sentinel_alert = spark.createDataFrame(
        [("ZZZ", "", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1, T0 + timedelta(days=2), T0 + timedelta(days=2))], ALERT)
    sentinel_alert.write.mode("append").parquet(f"{d}/alerts_sentinel")
    both = alerts_in.unionByName(spark.readStream.schema(ALERT).parquet(f"{d}/alerts_sentinel"))
    eps = run_to_sink(red_episodes_stream(both, watermark="10 seconds"), Sink(f"{d}/eps", f"{d}/ck2"))
    batch = red_episodes(got, bucket="5 minutes")
    norm = lambda df: sorted(tuple(r) for r in df.filter("tower_id != 'ZZZ'")
                             .select("tower_id", "episode_start", "episode_end", "alert_count").collect())
    assert norm(eps) == norm(batch)
