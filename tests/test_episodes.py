"""Red episodes: the bucketed distributed plan against a brute-force scan,
across bucket sizes, with ties and cross-bucket chains."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pylonflow.operators.episodes import red_episodes, red_episodes_stream, status_changes

T0 = datetime(2024, 1, 1)


def brute(rows, ttl_s):
    out = []
    for key in sorted({k for k, _ in rows}):
        ts = sorted(t for k, t in rows if k == key)
        start, last, n = ts[0], ts[0], 1
        for t in ts[1:]:
            if t - last > ttl_s:
                out.append((key, start, last + ttl_s, last, n))
                start, n = t, 0
            last, n = t, n + 1
        out.append((key, start, last + ttl_s, last, n))
    return sorted(out)


def run(spark, rows, ttl="90 seconds", bucket="1 day", fn=red_episodes):
    df = spark.createDataFrame([(k, T0 + timedelta(seconds=t)) for k, t in rows], "tower_id string, window_end timestamp")
    res = fn(df, ttl=ttl, bucket=bucket) if fn is red_episodes else fn(df, ttl=ttl, watermark=None)
    return sorted((r.tower_id, int((r.episode_start - T0).total_seconds()), int((r.episode_end - T0).total_seconds()),
                   int((r.last_alert - T0).total_seconds()), r.alert_count) for r in res.collect())


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 3000)), min_size=1, max_size=60),
       st.sampled_from(["1 minute", "5 minutes", "1 day"]))
def test_matches_brute_force(spark, rows, bucket):
    assert run(spark, rows, bucket=bucket) == brute(rows, 90)


def test_exact_ttl_gap_merges_and_long_chains(spark):
    rows = [("A", 0), ("A", 90), ("A", 180), ("A", 271), ("A", 271), ("B", 5)] + [("C", 60 * i) for i in range(200)]
    assert run(spark, rows, bucket="2 minutes") == brute(rows, 90)
    got = {r[0]: r for r in run(spark, rows, bucket="2 minutes")}
    assert got["C"] == ("C", 0, 199 * 60 + 90, 199 * 60, 200)  # one episode across 100 buckets


def test_session_window_twin_agrees(spark):
    rows = [("A", 0), ("A", 90), ("A", 181), ("B", 30), ("B", 100), ("B", 1000)]
    assert run(spark, rows, fn=red_episodes_stream) == brute(rows, 90)


def test_status_changes(spark):
    df = spark.createDataFrame([("A", T0), ("A", T0 + timedelta(seconds=60)), ("A", T0 + timedelta(seconds=600))],
                               "tower_id string, window_end timestamp")
    got = sorted((r.changed_at, r.status) for r in status_changes(df).collect())
    assert [s for _, s in got] == ["red", "green", "red", "green"]
    assert got[1][0] == T0 + timedelta(seconds=150)
