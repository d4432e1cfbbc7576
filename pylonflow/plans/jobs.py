"""Job entry points for ``spark-submit``.

    spark-submit --py-files pylonflow.zip -m pylonflow.plans.jobs batch \\
        --sf-dir s3://bucket/telemetry --query detect_alerts_60s --out s3://bucket/alerts
    spark-submit ... -m pylonflow.plans.jobs stream --telemetry s3://bucket/telemetry/ --trigger "10 seconds"

``batch`` materialises one registered query into a parquet table (overwrite).
``stream`` starts the five streaming queries of the alerting dataflow over a
telemetry folder (or the test ``events`` folder) and waits; state and tables live under
``spark.checkpoint.dir`` (required on a cluster), so a restarted job resumes
where it stopped.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session(app: str) -> SparkSession:
    from pylonflow.session import apply_engine_conf
    spark = SparkSession.builder.appName(app).getOrCreate()
    return apply_engine_conf(spark)


def run_batch(spark: SparkSession, sf_dir: str, query: str, out: str, partitions: int | None = None) -> None:
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    from pylonflow.plans.catalog import QUERIES
    df = QUERIES[query](spark, sf_dir)
    if partitions:
        df = df.repartition(partitions)
    df.write.mode("overwrite").parquet(out)


def load_callable(spec: str):
    """``"package.module:function"`` (the attribute may be dotted, e.g.
    ``"pkg.mod:Client.generate"``) -> the callable (the model client)."""
    import pkgutil
    if ":" not in spec:
        raise ValueError("model must be given as 'package.module:function'")
    obj = pkgutil.resolve_name(spec)
    if not callable(obj):
        raise ValueError(f"{spec!r} does not name a callable")
    return obj


def run_stream(spark: SparkSession, events_dir: str | None, trigger: str, timeout_s: float | None = None,
               wait: bool = True, telemetry_dir: str | None = None, max_files_per_trigger: int | None = None,
               name: str = "towers", root: str | None = None, model: str | None = None, keep: str | None = None,
               on_restart: str = "resume", feed: int | None = None):
    """Start the streaming dataflow over either a telemetry folder (records
    with the registered telemetry schema, the production shape) or an events
    folder (mapped to readings)."""
    from pylonflow.plans.dataflow import AlertingConfig, AlertingDataflow
    from pylonflow.schemas import TELEMETRY
    from pylonflow.sources.readings import COLUMNS, readings
    if (events_dir is None) == (telemetry_dir is None):
        raise ValueError("give exactly one of events_dir / telemetry_dir")
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if telemetry_dir is not None:
        telemetry = reader.schema(TELEMETRY).parquet(telemetry_dir)
    else:
        table = spark.read.parquet(events_dir).select(*COLUMNS)   # its schema only; streams never infer one
        telemetry = readings(reader.schema(table.schema).parquet(events_dir))
    from pylonflow.operators.infer import rule_model
    from pylonflow.session import checkpoint_root
    flow = AlertingDataflow(AlertingConfig(keep=keep, alert_feed=feed, runbook_feed=feed), load_callable(model) if model else rule_model)
    # a fixed folder per flow name: a restarted job resumes every query from its checkpoint
    root = root or f"{checkpoint_root(spark)}/pylonflow/flows/{name}"
    handles = flow.start(spark, telemetry, trigger=trigger, root=root, on_restart=on_restart)
    if not wait:
        return handles
    if timeout_s is None:
        spark.streams.awaitAnyTermination()
    else:
        spark.streams.awaitAnyTermination(timeout_s)
        handles.stop()
    return handles


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="pylonflow.plans.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("batch")
    b.add_argument("--sf-dir", required=True)
    b.add_argument("--query", required=True)
    b.add_argument("--out", required=True)
    b.add_argument("--partitions", type=int)
    s = sub.add_parser("stream")
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--telemetry", help="folder of telemetry records (registered schema)")
    src.add_argument("--events", help="folder of events (test data mapped to readings)")
    s.add_argument("--trigger", default="2 seconds")
    s.add_argument("--max-files-per-trigger", type=int)
    s.add_argument("--timeout", type=float)
    s.add_argument("--name", default="towers", help="flow name: its tables/checkpoints live under "
                   "<spark.checkpoint.dir>/pylonflow/flows/<name>, so a restart resumes")
    s.add_argument("--model", help="model client as 'package.module:function' (default: local stub)")
    s.add_argument("--keep", help="how long alerts, responses and runbooks stay, e.g. '8 hours' (default: for good)")
    s.add_argument("--on-restart", choices=("resume", "skip"), default="resume", help="skip drops the alerts that wait for an answer")
    s.add_argument("--feed", type=int, help="keep live feeds of so many alerts and runbooks")
    args = ap.parse_args(argv)
    spark = _session(f"pylonflow-{args.cmd}")
    if args.cmd == "batch":
        run_batch(spark, args.sf_dir, args.query, args.out, args.partitions)
    else:
        run_stream(spark, args.events, args.trigger, args.timeout, telemetry_dir=args.telemetry,
                   max_files_per_trigger=args.max_files_per_trigger, name=args.name, model=args.model,
                   keep=args.keep, on_restart=args.on_restart, feed=args.feed)


if __name__ == "__main__":
    main()
