"""Registering queries, and tables shared by several of them, in both languages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """``t.orders`` is the table of that name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Registers ``f(t)`` under its name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def donors(t: Tables) -> DataFrame:
    """family, donor_id, normal_id: customers as donor ids, some of them malformed."""
    from crosslink.functions.ids import normal_sense_id

    k = F.col("c_custkey")
    raw = F.when(k % 17 == 0, F.concat(F.lit("bad_"), k.cast("string"))).otherwise(F.concat(F.lit("c"), F.floor(k / 100).cast("string"), F.lit("-"), F.lpad((k % 100).cast("string"), 2, "0")))
    return t.customer.select(F.col("c_mktsegment").alias("family"), raw.alias("donor_id")).withColumn("normal_id", normal_sense_id(F.col("donor_id")))


DONORS = """donors AS (SELECT c_mktsegment AS family, d AS donor_id,
  CASE WHEN regexp_full_match(d, '.+-[0-9]{2}') THEN regexp_replace(d, '^(.+)-([0-9]{2})$', '\\1.\\2') END AS normal_id
  FROM (SELECT *, CASE WHEN c_custkey % 17 = 0 THEN 'bad_' || c_custkey ELSE 'c' || (c_custkey // 100) || '-' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') END AS d
  FROM customer))"""


def sources(t: Tables) -> DataFrame:
    """family, source_id: customers that ordered, for each family."""
    k = F.col("o_custkey")
    ids = t.orders.select("o_custkey").distinct().select(F.concat(F.lit("c"), F.floor(k / 100).cast("string"), F.lit("."), F.lpad((k % 100).cast("string"), 2, "0")).alias("source_id"), k)
    return ids.join(t.customer, ids.o_custkey == F.col("c_custkey")).filter("c_custkey % 5 <> 0").select(F.col("c_mktsegment").alias("family"), "source_id")


SOURCES = """sources AS (SELECT DISTINCT c_mktsegment AS family, 'c' || (c_custkey // 100) || '.' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') AS source_id
  FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey IN (SELECT o_custkey FROM orders))"""

MATCHED = f"""{DONORS}, {SOURCES}, matched AS (SELECT d.*,
  CASE WHEN d.family = 'BUILDING' THEN 'source_unavailable' WHEN normal_id IS NULL THEN 'invalid' WHEN s.source_id IS NOT NULL THEN 'matched' ELSE 'missing' END AS status
  FROM donors d LEFT JOIN sources s ON s.family = d.family AND s.source_id = d.normal_id)"""


def matched(t: Tables) -> DataFrame:
    from crosslink.operators.match import match_identifiers

    return match_identifiers(donors(t), sources(t), sources(t).select("family").filter("family <> 'BUILDING'"))


def half(c: Column) -> Column:
    return F.floor(c / 2)
