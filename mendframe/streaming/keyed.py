"""Running moments of every key of a stream, in state of our own with timers.

The rows of an Arrow batch are first combined by key, so state is touched once for many rows. The rows of a key
that is frequent in a batch are dealt at random over a few parts, each with its own state, so a key that holds a
third of the stream does not wait for one task; those of other keys meet in one part. State that stays idle is closed and freed; rows that come for
it later, however old, open the next episode. Parts and episodes merge to what one pass over all rows
gives: nothing is dropped for being late.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from mendframe.functions.columns import quoted
from mendframe.streaming import monitor

#: State of a part: when it opened (ms), rows, values, mean, squared deviations, extremes, first and last time (microseconds).
STATE = "opened long, rows long, n long, mean double, m2 double, low double, high double, first long, last long"
PARTS = 8
#: Rows of a key in an Arrow batch from which on they are dealt over the parts.
FREQUENT = 16
#: What the rows of a key part in an Arrow batch come to.
COMBINED = "rows long, n long, mean double, m2 double, low double, high double, first long, last long"


def running_moments(
    rows: DataFrame, keys: Sequence[str], time: str, value: str, idle: str = "1 hour", parts: int = PARTS
) -> DataFrame:
    """State versions of every key part that a micro-batch changed or closed; write them with `run_available`.

    `idle` is the processing time after which untouched state closes. Null keys are a key; rows with a null or NaN
    value or a null time count as rows and take no part in the moments or the time span. A time without zone counts as UTC.
    """
    fields = T.StructType([T.StructField(f"_k{i}", rows.schema[k].dataType) for i, k in enumerate(keys)])
    fields = T.StructType([*fields, T.StructField("part", T.IntegerType()), *T.StructType.fromDDL(STATE), T.StructField("closed", T.BooleanType())])
    moment = quoted(time)
    if isinstance(rows.schema[time].dataType, T.TimestampNTZType):
        moment = F.from_utc_timestamp(moment.cast("timestamp"), F.current_timezone())
    x = F.nanvl(quoted(value).cast("double"), F.lit(None).cast("double"))
    names = [f"_k{i}" for i in range(len(keys))]
    dealt = rows.select(
        *[quoted(k).alias(n) for n, k in zip(names, keys, strict=True)],
        F.floor(F.rand(1) * parts).cast("int").alias("part"),
        x.alias("x"),
        F.unix_micros(moment.cast("timestamp")).alias("t"),
    )
    shape = T.StructType([*fields.fields[: len(keys) + 1], *T.StructType.fromDDL(COMBINED)])
    combined = dealt.mapInArrow(lambda batches: (made for batch in batches for made in combine(batch, names)), shape)
    wait = _milliseconds(idle)

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            held = state.get
            state.remove()
            yield _version(key, held, True)
            return
        held = state.get if state.exists else (state.getCurrentProcessingTimeMs(), 0, 0, 0.0, 0.0, None, None, None, None)
        for frame in frames:
            for row in zip(*[frame[c].tolist() for c in frame.columns[-8:]], strict=True):
                held = merge(held, *row)
        state.update(held)
        state.setTimeoutDuration(wait)
        yield _version(key, held, False)

    def _version(key: tuple, held: tuple, closed: bool) -> pd.DataFrame:
        row = np.empty((1, len(fields)), dtype=object)
        for i, v in enumerate((*key, *held, closed)):
            row[0, i] = v
        return pd.DataFrame(row, columns=fields.names)

    versions = combined.groupBy(*names, "part").applyInPandasWithState(
        advance, fields, STATE, "update", GroupStateTimeout.ProcessingTimeTimeout
    )
    return versions.toDF(*keys, *versions.columns[len(keys):])


def run_available(versions: DataFrame, table: str, checkpoint: str) -> int:
    """`monitor.run_available` for states with processing-time timers, which ask for another batch without end.

    Batches without rows are off for this query, so the run stops once all that arrived is in. A timer
    that is due fires with the next batch that has rows.
    """
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    conf = versions.sparkSession.conf
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return monitor.run_available(versions, table, checkpoint)
    finally:
        conf.set(name, before)


def combine(batch: pa.RecordBatch, keys: Sequence[str]) -> list[pa.RecordBatch]:
    """Moments of every key part in a batch of rows (keys, part, x, t); rows of a key that is not `FREQUENT` in it are part 0."""
    table = pa.Table.from_batches([batch])
    if not table.num_rows:
        return []
    ids = np.zeros(table.num_rows, dtype=np.int64)
    for k in keys:
        codes = pc.dictionary_encode(table[k].combine_chunks(), null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        ids = np.unique(ids * (int(codes.max()) + 1) + codes, return_inverse=True)[1]
    part = np.where(np.bincount(ids)[ids] >= FREQUENT, table["part"].to_numpy(), 0)
    table = table.set_column(table.column_names.index("part"), "part", pa.array(part, pa.int32()))
    nothing = pc.CountOptions(mode="all")
    made = table.group_by([*keys, "part"]).aggregate(
        [("part", "count", nothing), ("x", "count"), ("x", "mean"), ("x", "variance"), ("x", "min"), ("x", "max"), ("t", "min"), ("t", "max")]
    )
    squares = pc.multiply(made["x_variance"], pc.cast(made["x_count"], pa.float64()))
    columns = [*[made[k] for k in keys], made["part"], made["part_count"], made["x_count"], made["x_mean"], squares]
    columns += [made[c] for c in ("x_min", "x_max", "t_min", "t_max")]
    names = [*keys, "part", "rows", "n", "mean", "m2", "low", "high", "first", "last"]
    return pa.table(columns, names=names).combine_chunks().to_batches()


def merge(held: tuple, rows, n, mean, m2, low, high, first, last) -> tuple:
    """The state after rows of the given moments, by the pairwise rule; without values or times theirs are null or NaN."""
    opened, all_rows, all_n, all_mean, all_m2, all_low, all_high, all_first, all_last = held
    n = int(n)
    if n:
        gap = mean - all_mean
        all_m2 += m2 + gap * gap * all_n * n / (all_n + n)
        all_mean += gap * n / (all_n + n)
        all_n += n
        all_low = low if all_low is None else min(all_low, low)
        all_high = high if all_high is None else max(all_high, high)
    if first is not None and first == first:
        all_first = int(first) if all_first is None else min(all_first, int(first))
        all_last = int(last) if all_last is None else max(all_last, int(last))
    return opened, all_rows + int(rows), all_n, all_mean, all_m2, all_low, all_high, all_first, all_last


def absorb(held: tuple, frame: pd.DataFrame) -> tuple:
    """The state after the rows of a frame (x, t)."""
    x, t = frame["x"].dropna(), frame["t"].dropna()
    m = float(x.mean()) if len(x) else None
    m2 = float(((x - m) ** 2).sum()) if len(x) else None
    ends = (float(x.min()), float(x.max())) if len(x) else (None, None)
    return merge(held, len(frame), len(x), m, m2, *ends, *((t.min(), t.max()) if len(t) else (None, None)))


def merged_moments(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, nulls, mean, deviation, extremes and time span of every key from the newest version of its parts.

    `repeated` tells keys with more than one row: for a stream keyed by what should be unique, its copies.
    """
    part = [*[quoted(k) for k in keys], F.col("part"), F.col("opened")]
    newest = F.row_number().over(Window.partitionBy(*part).orderBy(F.desc("batch"), F.desc("closed")))
    latest = versions.withColumn("_newest", newest).filter("_newest = 1")
    whole = Window.partitionBy(*[quoted(k) for k in keys])
    mean = F.try_divide(F.sum(F.col("mean") * F.col("n")).over(whole), F.sum("n").over(whole).cast("double"))
    around = latest.withColumn("_mean", mean)
    gap = F.col("mean") - F.col("_mean")
    squares = F.sum(F.when(F.col("n") > 0, F.col("m2") + F.col("n") * gap * gap))
    n = F.sum("n")
    return around.groupBy(*[quoted(k) for k in keys]).agg(
        F.sum("rows").alias("rows"),
        (F.sum("rows") - n).alias("nulls"),
        F.max("_mean").alias("mean"),
        F.when(n > 1, F.sqrt(squares / (n - 1))).alias("std"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.timestamp_micros(F.min("first")).alias("first"),
        F.timestamp_micros(F.max("last")).alias("last"),
        (F.sum("rows") > 1).alias("repeated"),
    )


def _milliseconds(span: str) -> int:
    return round(pd.Timedelta(span).total_seconds() * 1000)
