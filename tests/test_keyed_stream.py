import math
import time
from datetime import datetime, timedelta

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mendframe.streaming import keyed

SCHEMA = "t timestamp, user string, v double"
NAMES = ["rows", "nulls", "mean", "std", "low", "high", "first", "last", "repeated"]


def plain(df):
    """One pass over all rows."""
    x = F.nanvl("v", F.lit(None))
    return {
        r["user"]: r
        for r in df.groupBy("user").agg(
            F.count("*").alias("rows"), F.count_if(x.isNull()).alias("nulls"), F.avg(x).alias("mean"), F.stddev(x).alias("std"),
            F.min(x).alias("low"), F.max(x).alias("high"), F.min("t").alias("first"), F.max("t").alias("last"),
            (F.count("*") > 1).alias("repeated"),
        ).collect()
    }


def same(merged, source):
    expected, found = plain(source), {r["user"]: r for r in merged.collect()}
    assert set(found) == set(expected)
    for user, row in found.items():
        for name in NAMES:
            value = expected[user][name]
            assert row[name] == (pytest.approx(value) if isinstance(value, float) else value), (user, name)


def arrive(spark, path, start, users, days):
    """Rows of some users whose times start `days` later; every 10th has no value, every 15th no time."""
    rows = [
        (None if i % 15 == 0 else datetime(2024, 3, 1) + timedelta(hours=i, days=days), users[i % len(users)],
         float("nan") if i % 20 == 0 else None if i % 10 == 0 else math.sin(start + i) * 1e3 + 1e6)
        for i in range(60)
    ]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_equals_one_pass_with_restarts_and_late_rows(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "check"))
    hot = ["a"] * 6 + ["b", None, "c"]
    for number, (users, days) in enumerate([(hot, 0), (["b", "d"], 90), (hot, -60)]):  # the last are five months late
        arrive(spark, source, number * 100, users, days)
        arrive(spark, source, number * 100 + 50, users, days)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        versions = keyed.running_moments(stream, ["user"], "t", "v", idle="1 second", parts=3)
        assert keyed.run_available(versions, out, state) == 0
        same(keyed.merged_moments(spark.read.parquet(out), ["user"]), spark.read.parquet(source))
        time.sleep(1.2)  # timers of the keys that do not come again fire in the next run
    table = spark.read.parquet(out)
    assert table.filter("closed").count() > 0
    assert table.select("user", "part", "opened").distinct().count() > table.select("user", "part").distinct().count()
    assert table.filter("user = 'a'").select("part").distinct().count() == 3


def test_a_repeated_batch_counts_once(spark, tmp_path):
    """A run that fails after writing its batch writes it again: the versions replace each other."""
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "check"))
    arrive(spark, source, 0, ["a", "b"], 0)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    versions = keyed.running_moments(stream, ["user"], "t", "v", parts=2)
    failed = []

    def fails(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
        failed.append(number)
        raise RuntimeError("lost after the write")

    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    query = versions.writeStream.outputMode("update").foreachBatch(fails).option("checkpointLocation", state).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="lost after the write"):
        query.awaitTermination()
    spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    assert failed == [0]
    keyed.run_available(versions, out, state)
    same(keyed.merged_moments(spark.read.parquet(out), ["user"]), spark.read.parquet(source))


def test_absorb_merges_moments():
    held = (0, 0, 0, 0.0, 0.0, None, None, None, None)
    frames = [[1.0, 2.0], [], [float("nan")], [1e9, 1e9 + 1, 5.0]]
    for values in frames:
        held = keyed.absorb(held, pd.DataFrame({"x": pd.Series(values, dtype=float), "t": pd.Series([7.0] * len(values), dtype=float)}))
    series = pd.Series([1.0, 2.0, 1e9, 1e9 + 1, 5.0])
    assert held[1:3] == (6, 5) and held[3] == pytest.approx(series.mean()) and held[5:] == (1.0, 1e9 + 1, 7, 7)
    assert math.sqrt(held[4] / 4) == pytest.approx(series.std())


def test_rows_of_a_batch_are_combined_before_they_reach_state():
    """One partial per key of a batch; only a frequent key is dealt over its parts."""
    rows = [("a", i % 3, float(i), i) for i in range(30)] + [("b", 1, 1e9, 5), ("b", 2, 1e9 + 1, None), (None, 2, None, 7), ("b", 0, None, 3)]
    schema = pa.schema([("_k0", pa.string()), ("part", pa.int32()), ("x", pa.float64()), ("t", pa.int64())])
    batch = pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)
    found = {(r["_k0"], r["part"]): r for made in keyed.combine(batch, ["_k0"]) for r in made.to_pylist()}
    assert set(found) == {("a", 0), ("a", 1), ("a", 2), ("b", 0), (None, 0)}
    assert sum(r["rows"] for r in found.values()) == len(rows)
    b, none = found["b", 0], found[None, 0]
    assert (b["rows"], b["n"], b["mean"], b["m2"], b["low"], b["high"], b["first"], b["last"]) == (3, 2, 1e9 + 0.5, 0.5, 1e9, 1e9 + 1, 3, 5)
    assert (none["rows"], none["n"], none["mean"], none["first"], none["last"]) == (1, 0, None, 7, 7)
    assert keyed.combine(batch.slice(0, 0), ["_k0"]) == []
