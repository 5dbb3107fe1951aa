"""Connected components of a table of links, by rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosslink.llm.common import remove, write


def _least(pairs: DataFrame) -> DataFrame:
    """u, v, and m: the least of u and all its v."""
    least = pairs.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m"))
    return pairs.join(least, "u")


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """links (u, v), any order, repeats allowed -> node, root: root is the least node that can be reached.

    Alternating large and small stars: the links become stars around the least nodes in about log rounds. Each round is a
    table in the shared folder. Null ends and loops are left out; no links give no rows.
    """
    now = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v and u is not null and v is not null").distinct()
    (now, path), before = write(now, "links"), None
    for _ in range(most_rounds):
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _least(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v")
        (now, new), old = write(small.distinct(), "links"), path
        path = new
        remove(links.sparkSession, old)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
