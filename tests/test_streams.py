import pandas as pd
import pytest
from pyspark.sql import functions as F

from crosslink.functions.values import band
from crosslink.operators import match, windows
from crosslink.plans import matching, stored
from crosslink.plans.base import Tables, matched
from crosslink.streaming import streams


def stream(spark, df, path, files=3):
    df.repartition(files).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def drain(spark, df, name, mode="append"):
    df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start().awaitTermination(120)
    return spark.table(name)


def test_crosswalk(spark, sf_dir, tmp_path):
    t = Tables(spark, sf_dir)
    rows = matching.mappings(t)
    got = drain(spark, streams.stream_crosswalk(stream(spark, rows, str(tmp_path / "m")), matched(t)), "k1")
    want = match.crosswalk(rows, matched(t))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() > 0


def test_reviews_once(spark, sf_dir, tmp_path):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("record_id"), "ts", "value")
    twice = stream(spark, rows.unionByName(rows), str(tmp_path / "e"))
    out = str(tmp_path / "out")
    streams.append_reviews(twice, "ts", out, str(tmp_path / "ck"), "400 days").awaitTermination(120)
    got = streams.read_reviews(spark, out)
    assert got.count() == got.select("record_id").distinct().count() == rows.count()


def closed(spark, sf_dir, span, delay):
    """Times before which every window is closed once all events are read."""
    last = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.max("ts")).first()[0]
    return pd.Timestamp(last) - pd.Timedelta(delay) - pd.Timedelta(span)


def test_windows(spark, sf_dir, tmp_path):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    got = drain(spark, streams.window_features(stream(spark, ev.coalesce(1), str(tmp_path / "e"), 1), ["user_id"], "ts", "value", 50.0, 10.0), "k3")
    v = F.col("value")
    want = streams.event_time(ev).groupBy("user_id", F.window("ts", "1 day").alias("w")).agg(F.count(v).alias("n"), F.round(F.avg(v), 6).alias("mean"), band(F.avg(v), F.lit(50.0), F.lit(10.0)).alias("prediction")).select("user_id", F.col("w.start").alias("start"), "n", "mean", "prediction")
    until = closed(spark, sf_dir, "1 day", "1 hour")
    pick = lambda df: {tuple(r) for r in df.filter(F.col("start") < F.lit(until).cast("timestamp")).collect()}
    assert pick(got.select("user_id", "start", "n", F.round("mean", 6), "prediction")) == pick(want) and pick(want)


def test_sessions(spark, sf_dir, tmp_path):
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    got = drain(spark, streams.sessions(stream(spark, ev.coalesce(1), str(tmp_path / "e"), 1), ["user_id"], "ts", "6 hours"), "k4")
    want = streams.event_time(ev).groupBy("user_id", F.session_window("ts", "6 hours").alias("w")).agg(F.count("*").alias("n")).select("user_id", "w.start", "w.end", "n")
    until = closed(spark, sf_dir, "1 day", "1 hour")
    pick = lambda df: {tuple(r) for r in df.filter(F.col("end") < F.lit(until).cast("timestamp")).collect()}
    assert pick(got) == pick(want) and pick(want)


def rocks(spark):
    session = spark.newSession()
    session.conf.set(*streams.ROCKS)
    return session


def pairs(df):
    return sorted(map(tuple, df.select("key", "start", "end", "first", "second", "repeated").collect()))


def test_alternation(spark, sf_dir, tmp_path):
    """Events in any order over many small batches, then a tick that moves the watermark beyond all of them."""
    spark = rocks(spark)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    path, ck = str(tmp_path / "e"), str(tmp_path / "ck")
    ev.repartition(3, F.xxhash64("event_id")).write.parquet(path)
    tick = ev.limit(1).withColumn("ts", F.to_timestamp(F.lit("2100-01-01"))).withColumn("event_type", F.lit(None).cast("string"))
    tick.coalesce(1).write.mode("append").parquet(path)
    reader = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = streams.alternation(reader, "user_id", "ts", "event_type", "event_id", "4000 days", "20 days")
    query = out.writeStream.format("memory").queryName("k5").option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(200)
    want = windows.intervals(streams.event_time(ev), ["user_id"], "ts", "event_type", ["event_id"]).filter("end - start <= interval 20 days")
    want = want.select(F.col("user_id").cast("string").alias("key"), "start", "end", "first", "second", (F.col("first") == F.col("second")).alias("repeated"))
    assert pairs(spark.table("k5")) == pairs(want) and want.count() > 0
    progress = [p for p in query.recentProgress if p.stateOperators]
    assert len([p for p in progress if p.numInputRows]) == 4  # state crosses batches
    assert progress[-1].stateOperators[0].numRowsTotal == 0  # and nothing of it stays


def test_late_and_waiting_events(spark, tmp_path):
    spark = rocks(spark)
    path, schema = str(tmp_path / "e"), "user long, ts timestamp, label string, n long"
    files = [[(1, "2024-01-01 10:00:00", "a", 1), (1, "2024-01-01 08:00:00", "b", 2)], [(1, "2024-01-01 09:30:00", "c", 3), (2, "2024-01-01 14:00:00", "x", 4)], [(1, "2024-01-01 07:00:00", "too late", 5), (1, "2024-01-01 13:30:00", "d", 6), (1, "2024-01-01 13:30:00", "e", 7)]]
    for rows in files:
        spark.createDataFrame(rows, "user long, ts string, label string, n long").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = streams.alternation(reader, "user", "ts", "label", "n", "1 hour")
    out.writeStream.format("memory").queryName("k5late").outputMode("append").trigger(availableNow=True).start().awaitTermination(200)
    got = [(r.start.hour, r.end.hour, r.first, r.second) for r in spark.table("k5late").orderBy("start").collect()]
    assert got == [(8, 9, "b", "c"), (9, 10, "c", "a")]  # d and e wait for the watermark


def test_committed_once(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = lambda *ids: spark.createDataFrame([(i, f"{i}") for i in ids], "record_id long, text string")
    with pytest.raises(FileNotFoundError):
        streams.read_reviews(spark, path)
    assert streams.commit_batch(batch(1, 2, 2), 0, path) == 2
    batch(7, 8).write.parquet(f"{path}/batch=1")  # a batch that failed before its commit
    ids = lambda: sorted(r.record_id for r in streams.read_reviews(spark, path).collect())
    assert ids() == [1, 2]
    assert streams.commit_batch(batch(2, 3), 1, path) == 1 and ids() == [1, 2, 3]
    assert streams.commit_batch(batch(2, 3, 9), 1, path) == 1 and ids() == [1, 2, 3]
    assert streams.commit_batch(batch(1, 2, 3), 2, path) == 0 and ids() == [1, 2, 3]
    assert {(r.batch, r.rows) for r in streams.committed_batches(spark, path).collect()} == {(0, 2), (1, 1), (2, 0)}


def test_repeats_beyond_the_watermark(spark, tmp_path):
    path, out = str(tmp_path / "e"), str(tmp_path / "out")
    for rows in ([(1, "2024-01-01"), (2, "2024-01-02")], [(3, "2024-03-01")], [(1, "2024-03-02"), (4, "2024-03-02")]):
        spark.createDataFrame(rows, "record_id long, day string").select("record_id", F.col("day").cast("timestamp").alias("ts")).coalesce(1).write.mode("append").parquet(path)
    reader = spark.readStream.schema("record_id long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(path)
    for _ in range(2):  # the second run finds nothing new
        streams.append_reviews(reader, "ts", out, str(tmp_path / "ck"), "1 day").awaitTermination(120)
        rows = streams.read_reviews(spark, out).collect()
        assert sorted((r.record_id, r.ts.month) for r in rows) == [(1, 1), (2, 1), (3, 3), (4, 3)]


def test_window_mean_at_the_limit(spark, tmp_path):
    """A mean of exactly 40 is no contact, whatever the order of its events; as doubles these add up to more."""
    path, schema, values = str(tmp_path / "e"), "user long, ts timestamp, value double", [39.96] * 6 + [40.04] * 6
    rows = [(1, f"2024-01-01 10:00:{n:02d}", v) for n, v in enumerate(values)] + [(1, "2024-03-01 00:00:00", 0.0)]
    spark.createDataFrame(rows, "user long, ts string, value double").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(path)
    out = streams.window_features(spark.readStream.schema(schema).parquet(path), ["user"], "ts", "value", 50.0, 10.0)
    out.writeStream.format("memory").queryName("k3limit").outputMode("append").trigger(availableNow=True).start().awaitTermination(200)
    assert [(r.n, r.mean, r.prediction) for r in spark.table("k3limit").collect()] == [(len(values), 40.0, "no_contact")]


def test_keys_in_few_groups(spark, tmp_path):
    """Keys that share their state are paired, kept and let go each by itself while the watermark moves on; the state grows by groups, not by keys."""
    spark = rocks(spark)
    path, schema = str(tmp_path / "e"), "user long, ts timestamp, label string, n long"
    hour, users, n = 3_600_000_000, 60, F.col("id")
    at = F.lit(1_700_000_000_000_000) + n * (hour // 40) + F.pmod(n * 7919, F.lit(200)) * (hour // 400)  # up to half an hour out of order
    user = F.when(n % users > 0, n % users)  # one key is null
    n_ = F.when(n % 11 > 0, 2**60 + n % 3)  # whole numbers beyond a double, or none
    ev = spark.range(2360).filter("(id % 60) not between 20 and 29 or id < 600 or id > 1500").select(user.alias("user"), F.timestamp_micros(at).alias("ts"), F.when(n % 7 > 0, F.concat(F.lit("l"), n % 5)).alias("label"), n_.alias("n"))
    for first in range(0, 60, 10):  # files in order of time, six batches
        part = ev.filter(F.unix_micros("ts").between(1_700_000_000_000_000 + first * hour, 1_700_000_000_000_000 + (first + 10) * hour - 1))
        part.repartition(1).write.mode("append").parquet(path)
    tick = "select cast(null as bigint) user, timestamp '2100-01-01' ts, cast(null as string) label, cast(null as bigint) n"
    spark.sql(tick).coalesce(1).write.mode("append").parquet(path)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    query = streams.alternation(reader, "user", "ts", "label", "n", "1 hour", "5 hours", groups=4).writeStream.format("memory").queryName("k5groups").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(200)
    want = windows.intervals(ev.filter("label is not null"), ["user"], "ts", "label", ["n"]).filter("end - start <= interval 5 hours")
    want = want.select(F.col("user").cast("string").alias("key"), "start", "end", "first", "second", (F.col("first") == F.col("second")).alias("repeated"))
    known = lambda df: sorted(pairs(df.fillna("none", ["key"])))
    assert known(spark.table("k5groups")) == known(want) and want.count() > 1500
    progress = [p for p in query.recentProgress if p.stateOperators]
    assert len([p for p in progress if p.numInputRows]) == 7
    assert max(p.stateOperators[0].numRowsTotal for p in progress) < users < want.select("key").distinct().count() + 1
    assert progress[-1].stateOperators[0].numRowsTotal == 0


def test_partitions_of_the_state(spark, sf_dir):
    """The session of a stream with state has the caller's number of partitions, also when it was set on the session."""
    caller = spark.newSession()
    caller.conf.set("spark.sql.shuffle.partitions", "3")
    assert stored.with_state(Tables(caller, sf_dir)).conf.get("spark.sql.shuffle.partitions") == "3"
