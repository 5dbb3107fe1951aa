"""Streams: classification against static tables, idempotent appends, event-time windows, sessions, alternation with state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from crosslink.functions.values import band, exact_mean
from crosslink.operators.match import crosswalk


def event_time(df: DataFrame, at: str = "ts") -> DataFrame:
    """Times without zone as timestamps, which watermarks need."""
    return df.withColumn(at, F.col(at).cast("timestamp"))


def stream_crosswalk(mappings: DataFrame, comparisons: DataFrame, argument_source: str = "propbank") -> DataFrame:
    """Arriving mapping rows joined to the static comparisons: the batch operator on a stream."""
    return crosswalk(mappings, comparisons, argument_source)


def distinct_reviews(reviews: DataFrame, at: str, delay: str = "1 day") -> DataFrame:
    """Each record_id once, as long as its repeats come within the watermark."""
    return event_time(reviews, at).withWatermark(at, delay).dropDuplicatesWithinWatermark(["record_id"])


def committed_batches(spark: SparkSession, path: str) -> DataFrame:
    """batch, rows: the ledger of a table that ``append_reviews`` writes; empty if there is none yet."""
    at = f"{path.rstrip('/')}.ledger"
    place = spark._jvm.org.apache.hadoop.fs.Path(at)
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(LEDGER).parquet(at) if there else spark.createDataFrame([], LEDGER)


LEDGER = "batch long, rows long"


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all committed batches, with their batch. What a batch that failed has left is not among them."""
    done = [r.batch for r in committed_batches(spark, path).collect()]
    if not done:
        raise FileNotFoundError(f"{path} has no committed batch")
    return spark.read.option("basePath", path).parquet(*[f"{path.rstrip('/')}/batch={b}" for b in sorted(set(done))])


def commit_batch(batch: DataFrame, number: int, path: str) -> int:
    """Appends the rows of a batch whose record_id no committed batch has, each record once; returns how many.

    A batch that the ledger has is skipped. One that failed after writing, before it was committed, overwrites its own folder. Only
    the ids of the table are read to find those that are there, whatever their age.
    """
    spark = batch.sparkSession
    ledger = committed_batches(spark, path)
    if (was := ledger.filter(F.col("batch") == number).first()) is not None:
        return was.rows
    new = batch.drop("batch").dropDuplicates(["record_id"])
    if not ledger.isEmpty():
        new = new.join(read_reviews(spark, path).select("record_id"), "record_id", "left_anti")
    folder = f"{path.rstrip('/')}/batch={number}"
    new.write.mode("overwrite").parquet(folder)
    rows = spark.read.schema(new.schema).parquet(folder).count()
    spark.createDataFrame([(number, rows)], LEDGER).coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}.ledger")
    return rows


def append_reviews(reviews: DataFrame, at: str, path: str, checkpoint: str, delay: str = "1 day", **trigger):
    """Appends each review once to the table ``path`` (read it by ``read_reviews``), over restarts and however late its repeats come.

    Repeats within the watermark are dropped by the stream's state, older ones by the ids in the table; a batch that is run again
    changes nothing. Reviews older than the watermark are dropped.
    """
    write = lambda batch, number: commit_batch(batch, number, path) and None
    return distinct_reviews(reviews, at, delay).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def window_features(events: DataFrame, keys: list[str], at: str, value: str, center: float, half: float, length: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """keys, start, n, mean, std, rms and the band of the mean, for tumbling event-time windows."""
    v = F.col(value)
    out = event_time(events, at).withWatermark(at, delay).groupBy(*keys, F.window(at, length)).agg(F.count(v).alias("n"), exact_mean(v).alias("mean"), F.stddev_pop(v).alias("std"), F.sqrt(F.avg(v * v)).alias("rms"))
    return out.select(*keys, F.col("window.start").alias("start"), "n", "mean", "std", "rms", band(F.col("mean"), F.lit(center), F.lit(half)).alias("prediction"))


def sessions(events: DataFrame, keys: list[str], at: str, gap: str, delay: str = "1 hour") -> DataFrame:
    """keys, start, end, n: runs of events with no gap longer than ``gap``; identity can't be followed from one to the next."""
    out = event_time(events, at).withWatermark(at, delay).groupBy(*keys, F.session_window(at, gap)).agg(F.count("*").alias("n"))
    return out.select(*keys, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


ALTERNATION = "key string, start long, end long, first string, second string, repeated boolean"
#: The state store that transformWithState needs.
ROCKS = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
EVENTS = pa.schema([("key", pa.string()), ("at_us", pa.int64()), ("tie", pa.int64()), ("label", pa.string())])
#: Events in one value of the state.
BLOCK = 10_000


def packed(events: pa.Table) -> bytes:
    """A table of events as the bytes of an Arrow stream."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, EVENTS) as out:
        out.write_table(events.select(EVENTS.names))
    return sink.getvalue().to_pybytes()


def unpacked(blocks: list[bytes]) -> pa.Table:
    return pa.concat_tables([EVENTS.empty_table(), *[pa.ipc.open_stream(b).read_all() for b in blocks]])


class Alternation(StatefulProcessor):
    """Per group of keys: events that the watermark has not passed wait in a list of blocks; a timer sorts those that it has passed and pairs each with the one before of its key.

    Each call to the state costs about as much for one event as for a block of them, so the calls are made for groups of keys, and
    blocks whose first event is still ahead of the watermark are put back unread. The last event paired of each key is kept until
    the watermark is ``idle`` microseconds beyond it, then nothing of the key is left.
    """

    def __init__(self, idle: int | None):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "first long, events binary")
        self.last = handle.getValueState("last", "events binary")

    def timer(self, at: int) -> None:
        self.handle.registerTimer(-(-at // 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        earliest = []
        for part in rows:
            part = part[part["label"].notna()]  # here, as a filter would move below the watermark
            if len(part):
                earliest.append(int(part["at_us"].min()))
                self.waiting.appendValue((earliest[-1], packed(pa.Table.from_pandas(part[EVENTS.names], EVENTS, preserve_index=False))))
        if earliest:
            self.timer(min(earliest))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        blocks = list(self.waiting.get())
        reached = unpacked([events for first, events in blocks if first <= passed])
        later = [(first, events) for first, events in blocks if first > passed]
        ready = reached.filter(pc.less_equal(reached["at_us"], passed))
        if reached.num_rows:
            rest = reached.filter(pc.greater(reached["at_us"], passed)).sort_by("at_us")
            parts = [rest.slice(n, BLOCK) for n in range(0, rest.num_rows, BLOCK)]
            later += [(part["at_us"][0].as_py(), packed(part)) for part in parts]
            self.waiting.put(later) if later else self.waiting.clear()
        if later:
            self.timer(min(first for first, _ in later))
        yield from self.pairs(ready, passed)

    def pairs(self, ready: pa.Table, passed: int) -> Iterator[pd.DataFrame]:
        """The pairs that the events ``ready`` make with those before; the last event of each key is kept."""
        before = unpacked([self.last.get()[0]] if self.last.exists() else [])
        rows = pa.concat_tables([t.append_column("new", pa.array([new] * t.num_rows, pa.int8())) for new, t in enumerate((before, ready))])
        if not rows.num_rows:
            return
        rows = rows.sort_by([(c, "ascending") for c in ("key", "new", "at_us", "tie", "label")])
        keys, at = rows["key"].combine_chunks().dictionary_encode("encode").indices.to_numpy(), rows["at_us"].to_numpy()
        paired = keys[1:] == keys[:-1]
        kept = np.append(~paired, True)
        if self.idle is not None:
            paired, kept = paired & (np.diff(at) <= self.idle), kept & (at + self.idle > passed)
        if ready.num_rows or kept.sum() < before.num_rows:
            self.last.update((packed(rows.filter(pa.array(kept))),)) if kept.any() else self.last.clear()
        if kept.any() and self.idle is not None:
            self.timer(int(at[kept].min()) + self.idle)
        if paired.any():
            name, label = (rows[c].to_pandas().to_numpy() for c in ("key", "label"))
            first, second = label[:-1][paired], label[1:][paired]
            yield pd.DataFrame({"key": name[1:][paired], "start": at[:-1][paired], "end": at[1:][paired], "first": first, "second": second, "repeated": first == second})

    def close(self) -> None:
        pass


def alternation(events: DataFrame, key: str, at: str, label: str, tie: str, delay: str = "1 hour", idle: str | None = None, groups: int = 1024) -> DataFrame:
    """key, start, end, first, second, repeated: each event with the next one of its key, by time and ``tie`` (a whole number).

    Events may come in any order as long as they are not more than ``delay`` behind the latest; an event is paired when the
    watermark has passed it, later ones are dropped. Events without a label are not paired, but move the watermark. Events more
    than ``idle`` (an interval) apart are no pair, and state is kept no longer than that; without it the last event of a key stays.
    Keys are dealt to ``groups`` that share their state: it must be the same whenever a checkpoint is continued, and the waiting
    events of a group must fit a task. The session's state store must be RocksDB (``ROCKS``).
    """
    span = int(pd.Timedelta(idle).value // 1000) if idle else None
    ready = event_time(events, at).withWatermark(at, delay).filter(F.col(at).isNotNull())
    name, tie_ = F.col(key).cast("string"), F.coalesce(F.col(tie).cast("long"), F.lit(-(2**63)))  # without a null, so that pandas keeps whole numbers
    ready = ready.select(F.pmod(F.xxhash64(name), F.lit(groups)).alias("group"), name.alias("key"), F.col(at).alias("at"), F.unix_micros(at).alias("at_us"), F.col(label).alias("label"), tie_.alias("tie"))
    out = ready.groupBy("group").transformWithStateInPandas(Alternation(span), ALTERNATION, "append", "eventtime")
    return out.select("key", *[F.timestamp_micros(c).alias(c) for c in ("start", "end")], "first", "second", "repeated")
