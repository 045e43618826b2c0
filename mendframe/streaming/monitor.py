"""Continuous monitoring: windowed health counts of a stream, kept in a table of window versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mendframe.functions.columns import quoted
from mendframe.functions.numeric import percent
from mendframe.operators.profile import beyond_fences


def windowed_health(
    rows: DataFrame,
    time: str,
    value: str,
    fences: tuple[float, float],
    by: Sequence[str] = (),
    every: str = "1 day",
    lateness: str = "2 days",
) -> DataFrame:
    """Rows, nulls, zeros and outliers of a value per time window; the same for a stream or a table.

    The state holds a few counters per open window and group; windows older than the lateness go.
    """
    window = F.window(quoted(time), every)
    moment = quoted(time).cast("timestamp")
    if isinstance(rows.schema[time].dataType, T.TimestampNTZType):
        moment = F.from_utc_timestamp(moment, F.current_timezone())  # a time without zone counts as UTC
    counted = (
        rows.withColumn(time, moment)
        .withWatermark(time, lateness)
        .groupBy(window.alias("window"), *[quoted(c) for c in by])
        .agg(
            F.count("*").alias("rows"),
            F.count_if(quoted(value).isNull()).alias("nulls"),
            F.count_if(quoted(value) == 0).alias("zeros"),
            F.count_if(beyond_fences(quoted(value), fences)).alias("outliers"),
        )
    )
    return counted.select(
        F.col("window.start").alias("window_start"),
        *[quoted(c) for c in by],
        "rows",
        "nulls",
        "zeros",
        "outliers",
        (100 - percent(F.col("nulls") + F.col("zeros") + F.col("outliers"), F.col("rows"))).alias("reliability"),
    )


def run_available(health: DataFrame, table: str, checkpoint: str) -> int:
    """Process what has arrived and stop; each batch appends the windows it changed.

    A repeated batch after a failure overwrites its own part of the table, so it counts once. Returns
    how many partial counts (of a task, window and group) came too late and are in no window: 0 if
    nothing was lost.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    query = (
        health.writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(state.numRowsDroppedByWatermark for step in query.recentProgress for state in step.stateOperators)


def latest_windows(versions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The newest version of each window."""
    newest = Window.partitionBy("window_start", *by).orderBy(F.desc("batch"))
    return versions.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n", "batch")
