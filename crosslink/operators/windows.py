"""Sequences: intervals, gaps, sample windows, ranks, samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crosslink.scratch import written


def priority_limit(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def first_seen(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")


def with_borders(df: DataFrame, keys: list[str], order: list[str], keep: Column | None = None) -> DataFrame:
    """``df`` dealt by ranges of keys and order, with range (its number) and own (true); and, own false, for each range of a key its last row before that range.

    A key with most of the rows is in many ranges and so in many tasks. Ordered work goes on within (keys, range): what it needs of
    earlier rows stands in the row carried over the border, which comes from a small table of one row for each key and range.
    ``keep``: which rows can be carried. Rows that agree in keys and order are in one range.
    """
    dealt = written(df.repartitionByRange(*keys, *order).withColumn("range", F.spark_partition_id()), "ranges")
    place = F.struct(*order)
    chosen = keep if keep is not None else F.lit(True)
    borders = dealt.groupBy(*keys, "range").agg(F.max_by(F.when(chosen, F.struct(*df.columns)), F.when(chosen, place)).alias("last"))
    before = W.partitionBy(*keys).orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    carried = borders.select("range", F.last("last", ignorenulls=True).over(before).alias("last")).filter("last is not null").select("last.*", "range", F.lit(False).alias("own"))
    return dealt.withColumn("own", F.lit(True)).unionByName(carried)


def _steps(events: DataFrame, keys: list[str], columns: dict[str, Column], ties: list[Column]) -> DataFrame:
    """k0.., the columns, and last, the struct of these in the row before of the same keys; by the first column, then ties, then the others."""
    named = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)] + [c.alias(n) for n, c in columns.items()] + [c.alias(f"t{i}") for i, c in enumerate(ties)]
    ks, names = [f"k{i}" for i in range(len(keys))], list(columns)
    order = [names[0], *[f"t{i}" for i in range(len(ties))], *names[1:]]
    rows = with_borders(events.select(*named), ks, order)
    w = W.partitionBy(*ks, "range").orderBy(*order)
    return rows.withColumn("last", F.lag(F.struct(*names)).over(w)).filter("own")


def intervals(events: DataFrame, keys: list[str], at: str, label: str, ties: list[str]) -> DataFrame:
    """keys, start, end, first, second: each event with the next one of its key."""
    out = _steps(events, keys, {"at": F.col(at), "label": F.col(label)}, [F.col(c) for c in ties]).filter("at is not null and last is not null")
    return out.select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], F.col("last.at").alias("start"), F.col("at").alias("end"), F.col("last.label").alias("first"), F.col("label").alias("second"))


def alternation_violations(events: DataFrame, keys: list[str], at: str, label: str, ties: list[str]) -> DataFrame:
    """keys, at, label of events whose label equals the one before; and keys with a single event (at null)."""
    named = [F.col(f"k{i}").alias(k) for i, k in enumerate(keys)]
    same = _steps(events, keys, {"at": F.col(at), "label": F.col(label)}, [F.col(c) for c in ties]).filter("label = last.label").select(*named, "at", "label", F.lit("REPEATED").alias("code"))
    few = events.groupBy(*keys).agg(F.count("*").alias("__n")).filter("__n < 2").select(*keys, F.lit(None).cast(events.schema[at].dataType).alias("at"), F.lit(None).cast("string").alias("label"), F.lit("TOO_FEW").alias("code"))
    return same.unionByName(few)


def max_gap(events: DataFrame, keys: list[str], at: str) -> DataFrame:
    """keys, max_gap between distinct times; null with fewer than two."""
    steps = _steps(events.select(*keys, at).distinct(), keys, {"at": F.col(at)}, [])
    return steps.withColumn("gap", F.col("at") - F.col("last.at")).groupBy(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)]).agg(F.max("gap").alias("max_gap"))


def tumbling(samples: DataFrame, keys: list[str], index: str, size: int, aggs: list[Column]) -> DataFrame:
    """keys, window, n and the aggregates over full windows of ``size`` samples; an incomplete tail is left out."""
    out = samples.withColumn("window", F.floor(F.col(index) / size).cast("long")).groupBy(*keys, "window").agg(F.count("*").alias("n"), *aggs)
    return out.filter(F.col("n") == size)


def sliding(samples: DataFrame, keys: list[str], index: str, size: int, stride: int, aggs: list[Column]) -> DataFrame:
    """keys, start, n and the aggregates over full windows that start every ``stride`` samples: each sample goes to its size / stride windows."""
    last = F.floor(F.col(index) / stride).cast("long")
    first = F.greatest(F.lit(0), F.ceil((F.col(index) - size + 1) / stride)).cast("long")
    spread = samples.filter(first <= last).withColumn("start", F.explode(F.transform(F.sequence(first, last), lambda x: x * stride)))
    return spread.groupBy(*keys, "start").agg(F.count("*").alias("n"), *aggs).filter(F.col("n") == size)


def central_window(segments: DataFrame, limit: str | None = None, most: int = 128) -> DataFrame:
    """``segments`` (start, end inclusive) with ws, we: the central ``most`` samples at most; ends are cut to limit - 1, empty ones go."""
    end = F.col("end") if limit is None else F.least(F.col("end"), F.col(limit) - 1)
    length, n = end - F.col("start") + 1, F.least(F.lit(most), end - F.col("start") + 1)
    ws = F.col("start") + F.floor((length - n) / 2).cast("long")
    return segments.filter(end > F.col("start")).select(*segments.columns, ws.alias("ws"), (ws + n).alias("we"))


def samples_in_segments(samples: DataFrame, segments: DataFrame, keys: list[str], index: str, bucket: int = 1024) -> DataFrame:
    """Samples joined to the windows [ws, we) of their key, by equal buckets of the index and then the range."""
    pieces = segments.withColumn("__b", F.explode(F.sequence(F.floor(F.col("ws") / bucket), F.floor((F.col("we") - 1) / bucket))))
    return samples.withColumn("__b", F.floor(F.col(index) / bucket)).join(pieces, [*keys, "__b"]).filter((F.col(index) >= F.col("ws")) & (F.col(index) < F.col("we"))).drop("__b")


def windows_in_intervals(windows: DataFrame, parts: DataFrame, keys: list[str], margin: float) -> DataFrame:
    """``windows`` (start, end) with reference: the label of the interval that holds them with a margin at both ends, else null.

    ``parts``: start, end, label; disjoint within a key. The last interval that starts before a window is the only one that
    can hold it, so one ordered pass over starts and windows does, without a range join; a key with many rows is passed in ranges.
    """
    named = [F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]
    ks = [f"k{i}" for i in range(len(keys))]
    a = parts.select(*named, (F.col("start") + margin).cast("double").alias("at"), F.lit(0).alias("kind"), F.struct((F.col("end") - margin).alias("to"), "label").alias("part"))
    b = windows.select(*named, F.col("start").cast("double").alias("at"), F.lit(1).alias("kind"), F.struct(*windows.columns).alias("row"))
    both = with_borders(a.unionByName(b, allowMissingColumns=True), ks, ["at", "kind"], F.col("kind") == 0)
    w = W.partitionBy(*ks, "range").orderBy("at", "kind").rowsBetween(W.unboundedPreceding, 0)
    out = both.withColumn("last", F.last("part", ignorenulls=True).over(w)).filter("own and kind = 1")
    return out.select("row.*", F.when(F.col("row.end") <= F.col("last.to"), F.col("last.label")).alias("reference"))


def bounded_failures(df: DataFrame, right: str, order: list, n: int) -> DataFrame:
    return df.filter(~F.col(right)).orderBy(*order).limit(n)


def seeded_sample(df: DataFrame, key: str, seed: str, n: int) -> DataFrame:
    """The same ``n`` rows for a seed: least hash of seed and key first."""
    return df.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256), key).limit(n)


def distractors(items: DataFrame, pool: DataFrame, k: int, probes: int = 8) -> DataFrame:
    """id, distractor: ``k`` ids of the pool for each item that are not among its expected ones. items: id, expected (array).

    The pool is numbered; an item looks at ``k`` + size(expected) + ``probes`` numbers from its own hash on, so no item meets the whole pool.
    """
    pool = pool.select("candidate").distinct()
    total = pool.count()
    if not total:
        return items.select("id", F.lit(None).cast("string").alias("distractor")).filter("false")
    parts = pool.withColumn("__h", F.sha2(F.col("candidate").cast("string"), 256)).withColumn("__b", F.substring("__h", 1, 2))
    before = parts.groupBy("__b").count().withColumn("__o", F.coalesce(F.sum("count").over(W.orderBy("__b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("__b", "__o")  # 256 rows
    numbered = parts.join(F.broadcast(before), "__b").withColumn("__n", (F.row_number().over(W.partitionBy("__b").orderBy("__h")) - 1 + F.col("__o")).cast("long")).select("candidate", "__n")
    first = F.pmod(F.conv(F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 12), 16, 10).cast("long"), F.lit(total))
    looks = F.least(F.lit(total), F.size("expected") + k + probes).cast("long")
    asked = items.select("id", "expected", F.posexplode(F.transform(F.sequence(F.lit(0).cast("long"), looks - 1), lambda i: F.pmod(first + i, F.lit(total)))).alias("__p", "__n"))
    hits = asked.join(numbered, "__n").filter(~F.array_contains("expected", F.col("candidate")))
    return hits.withColumn("__r", F.row_number().over(W.partitionBy("id").orderBy("__p"))).filter(F.col("__r") <= k).select("id", F.col("candidate").alias("distractor"))


def canonical_sort(df: DataFrame, columns: list[str]) -> DataFrame:
    """A total order over files: ranges of the columns, sorted within."""
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def percentile_normalized(df: DataFrame, keys: list[str], value: str, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """``df`` with normal: value between its group's exact quantiles, cut to [0, 1]; null where they coincide."""
    from crosslink.functions.values import clipped
    from crosslink.operators.metrics import exact_quantiles

    q = exact_quantiles(df, keys, value, {"__low": low, "__high": high})
    return df.join(q, keys, "left").withColumn("normal", clipped(F.col(value), F.col("__low"), F.col("__high"))).drop("__low", "__high")
