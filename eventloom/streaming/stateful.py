"""Streams with a small state per key: throttle, failure alerts and flush buffers.

Every micro-batch is handed to the batch operator, which cuts large keys into ranges, together with the
state that the micro-batch before left. What comes out and the new state are written under the number of
the micro-batch; when it is run again after a failure, it starts from the same state and replaces both.
No task holds the rows that one key has in a micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.delivery import is_failure_signal, is_success
from ..operators.logs import build_log_batches, to_log_wire
from ..operators.slices import ROWS_PER_SLICE, numbered, running
from ..operators.throttle import BUCKETS, throttle_from
from ..session import delete_folder, finished_folders

Step = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


def with_state(
    stream: DataFrame, path: str, checkpoint: str, state_schema: str, step: Step, trigger: dict | None = None
) -> StreamingQuery:
    """Run ``step(batch, state)``, which returns rows and the new state, on every micro-batch.

    Rows go to ``path/out/micro_batch=n``, the state to ``path/state/n``; states older than the one before
    are deleted. ``trigger`` takes the arguments of Spark's trigger; by default what is available is
    processed once.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = (spark.read.schema(state_schema).parquet(f"{path}/state/{number - 1}") if number
                  else spark.createDataFrame([], state_schema))
        out, state = step(batch, before)
        out.write.mode("overwrite").parquet(f"{path}/out/micro_batch={number}")
        state.write.mode("overwrite").parquet(f"{path}/state/{number}")
        if number > 1:
            delete_folder(spark, f"{path}/state/{number - 2}")

    return (stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
            .trigger(**(trigger or {"availableNow": True})).start())


def latest_state(spark, path: str, schema: str) -> DataFrame | None:
    """The state after the last micro-batch that was finished, if any."""
    done = [int(n) for n in finished_folders(spark, f"{path}/state")]
    return spark.read.schema(schema).parquet(f"{path}/state/{max(done)}") if done else None


def stream_throttle(
    events: DataFrame, path: str, checkpoint: str, key: str = "sender_id", rate: str | int | Fraction = "10",
    burst: int = 20, ts: str = "ts", columns: Sequence[str] = ("event_id", "seq"), trigger: dict | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> StreamingQuery:
    """Token bucket per key across micro-batches; writes ``columns`` and ``allowed``.

    Rows of a micro-batch are decided in order of seq, then event_id, from the buckets left before; rows
    older than the last one decided gain no tokens. Null keys share one bucket, rows without a time pass.
    """
    columns = list(columns)

    def step(batch: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        tie = [c for c in ("event_id",) if c in batch.columns]
        rows = batch.select(*dict.fromkeys([*columns, key, "seq", *tie, ts]))
        decided, buckets = throttle_from(rows, state, key, rate, burst, ts=ts, rows_per_slice=rows_per_slice)
        return decided.select(*columns, F.col("drop_reason").isNull().alias("allowed")), buckets

    return with_state(events, path, checkpoint, BUCKETS, step, trigger)


#: Failures of an endpoint so far, and the second of its last signal.
RUNS = "endpoint string, failures long, second long"


def failure_alerts(
    attempts: DataFrame, path: str, checkpoint: str, threshold: int = 5, endpoint: str = "endpoint",
    open_seconds: int = 60, ts: str = "ts", trigger: dict | None = None, rows_per_slice: int = ROWS_PER_SLICE,
) -> StreamingQuery:
    """One row whenever an endpoint reaches ``threshold`` consecutive failure signals.

    A success clears the run, and so does a silence of an hour or four open periods, whichever is
    longer. 4xx answers, and attempts without a time, don't count as signals. Signals are taken in order of
    seq, then event_id, within a micro-batch. The state holds endpoints with a run alone.
    """
    keep = max(3600, 4 * open_seconds)

    def step(batch: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        code = F.col("status")
        tie = [c for c in ("event_id",) if c in batch.columns]
        signals = batch.where((is_success(code) | is_failure_signal(code)) & F.col(ts).isNotNull()).select(
            F.coalesce(F.col(endpoint).cast("string"), F.lit("")).alias("endpoint"), F.lit(1).alias("kind"), "seq", *tie,
            F.unix_seconds(F.col(ts).cast("timestamp")).alias("second"), is_success(code).alias("good"),
            is_failure_signal(code).cast("long").alias("amount"))
        # The run so far stands for its failures, ahead of all rows.
        line = signals.unionByName(state.select(
            "endpoint", F.lit(0).alias("kind"), "second", F.lit(False).alias("good"), F.col("failures").alias("amount")),
            allowMissingColumns=True)
        line = line.withColumn("place", F.struct("kind", "seq", *tie)).drop(*tie)
        seen = running(line, ["endpoint"], "place", {"total": (F.col("amount"), None)}, {"before": F.col("second")},
                       rows_per_slice=rows_per_slice)
        cleared = F.col("good") | F.coalesce(F.col("second") - F.col("before") > keep, F.lit(False))
        seen = running(seen, ["endpoint"], "place", lasts={"base": F.when(cleared, F.col("total"))}, rows_per_slice=rows_per_slice)
        run = F.col("total") + F.col("amount") - F.when(cleared, F.col("total")).otherwise(F.coalesce("base", F.lit(0)))
        runs = seen.withColumn("failures", run)
        fired = runs.where((F.col("kind") == 1) & (F.col("amount") > 0) & (F.col("failures") == threshold)).select(
            "endpoint", "seq", "failures")
        left = runs.groupBy("endpoint").agg(F.max_by(F.struct("failures", "second"), "place").alias("left"))
        return fired, left.select("endpoint", "left.*").where("failures > 0")

    return with_state(attempts, path, checkpoint, RUNS, step, trigger)


def stream_log_batches(
    records: DataFrame, path: str, checkpoint: str, size: int = 1000, by: Sequence[str] = ("sender_id",),
    trigger: dict | None = None, rows_per_slice: int = ROWS_PER_SLICE,
) -> StreamingQuery:
    """Write full batches of each sender (``by``, where these columns are there) in ``seq`` order.

    What is left of a sender, fewer than ``size`` records, stays in its buffer and opens the next
    batch; ``flush_log_batches`` sends it at the end. Records that come late take their place by ``seq`` in
    the open buffer.
    """
    fields = _buffered(records.schema, by)

    def step(batch: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = _named(state.unionByName(batch.select(*fields.names)), by)
        placed = numbered(rows, ["flush_id"], "seq", "__place", rows_per_slice)
        full = F.floor(F.count(F.lit(1)) / size) * size
        met = placed.join(rows.groupBy("flush_id").agg(full.alias("__full")), "flush_id")
        sent, left = met.where(F.col("__place") < F.col("__full")), met.where(F.col("__place") >= F.col("__full"))
        return build_log_batches(to_log_wire(sent.drop("__full")), size, place="__place"), left.select(*fields.names)

    return with_state(records, path, checkpoint, _ddl(fields), step, trigger)


def flush_log_batches(
    spark: SparkSession, path: str, schema: T.StructType, size: int = 1000, by: Sequence[str] = ("sender_id",),
) -> DataFrame:
    """The bodies of what the senders' buffers still hold after the last micro-batch; ``schema`` is that of
    the records that were streamed."""
    fields = _buffered(schema, by)
    left = latest_state(spark, path, _ddl(fields))
    left = spark.createDataFrame([], fields) if left is None else left
    return build_log_batches(to_log_wire(_named(left, by)), size)


#: What a buffer keeps of a record, beside the columns that name its sender.
_RECORD = ("seq", "event_id", "level", "message", "context", "timestamp", "app_name", "environment")


def _buffered(schema: T.StructType, by: Sequence[str]) -> T.StructType:
    return T.StructType([f for f in schema if f.name in (*by, *_RECORD)])


def _ddl(fields: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def _named(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add the sender as ``flush_id``; null and empty names are different senders."""
    names = [F.col(c).cast("string") for c in by if c in rows.columns]
    return rows.withColumn("flush_id", F.concat_ws("/", F.lit("sender"), *[
        F.coalesce(F.concat(F.lit("="), n), F.lit("")) for n in names]))
