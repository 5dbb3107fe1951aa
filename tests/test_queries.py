import pytest
from tests.oracle import compare

import __spark_entry__ as entry
from crosslink.plans import ORACLES, QUERIES


#: Queries that find nothing in the smallest tables.
EMPTY = {"prune_source_files"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, name):
    ours, theirs = compare(spark, sf_dir, QUERIES[name], ORACLES[name])
    assert ours == theirs
    assert ours or name in EMPTY


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_digest_ignores_order(spark, sf_dir):
    rows = QUERIES["content_digest"](spark, sf_dir).collect()
    assert len({(r.rows, r.digest) for r in rows}) == 1


def test_distractors_avoid_expected(spark, sf_dir):
    from pyspark.sql import functions as F

    got = QUERIES["add_distractors"](spark, sf_dir)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_custkey").alias("id"), (F.col("o_orderkey") % 200).alias("distractor")).distinct()
    assert got.join(orders, ["id", "distractor"]).count() == 0
    counts = {r.id: r["count"] for r in got.groupBy("id").count().collect()}
    assert set(counts.values()) == {3} and len(counts) == orders.select("id").distinct().count()
    assert got.distinct().count() == got.count()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
