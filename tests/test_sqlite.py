import sqlite3

import pytest
from pyspark.sql import functions as F

from crosslink.sources import sqlite


@pytest.fixture
def folder(tmp_path):
    """Two files with gaps in their row ids, nulls, blobs and odd names."""
    for f, (a, b) in enumerate(((1, 2500), (7000, 7300))):
        with sqlite3.connect(tmp_path / f"{f}.db") as db:
            db.execute('CREATE TABLE predicates (name TEXT, "sense num" INTEGER, confidence REAL, raw BLOB, note VARCHAR(20))')
            db.executemany("INSERT INTO predicates (rowid, name, \"sense num\", confidence, raw, note) VALUES (?, ?, ?, ?, ?, ?)", [(i, f"p{i}", i % 7 or None, i / 8, bytes([i % 256]), None if i % 3 else "it's") for i in range(a, b) if i % 11])
            db.execute("CREATE TABLE keyed (k TEXT PRIMARY KEY, v INTEGER) WITHOUT ROWID")
            db.executemany("INSERT INTO keyed VALUES (?, ?)", [(f"k{f}{i}", i) for i in range(20)])
            db.execute("CREATE TABLE none_yet (x INTEGER)")
    return tmp_path


def test_equals_parquet(spark, folder, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("q") / "t")
    df = sqlite.scan_sqlite(spark, str(folder), "predicates", partition_rows=400)
    assert df.dtypes == [("name", "string"), ("sense num", "bigint"), ("confidence", "double"), ("raw", "binary"), ("note", "string")]
    assert df.rdd.getNumPartitions() == 8
    df.write.parquet(out)
    rows = sorted(map(tuple, spark.read.parquet(out).collect()))
    assert rows == sorted((f"p{i}", i % 7 or None, i / 8, bytes([i % 256]), None if i % 3 else "it's") for a, b in ((1, 2500), (7000, 7300)) for i in range(a, b) if i % 11)
    one = sqlite.scan_sqlite(spark, f"file:{folder}/0.db", "predicates", {"confidence": "double", "name": "string"})
    assert one.columns == ["confidence", "name"] and one.count() == len([i for i in range(1, 2500) if i % 11]) and one.rdd.getNumPartitions() == 1


def test_filters_reach_the_database(spark, folder):
    spark = spark.newSession()
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    df = sqlite.scan_sqlite(spark, str(folder), "predicates", partition_rows=1000)
    num = F.col("`sense num`")
    cases = [num > 3, num.isNull(), num.isNotNull() & (F.col("confidence") <= 20.5), F.col("name").isin("p1", "p7001", "x"), F.col("note") == "it's", ~(num == 3), F.length("name") > 4, (num >= 2) & (num < 5) & (F.col("name") != "p9")]
    plain = spark.createDataFrame(df.collect(), df.schema)
    for case in cases:
        assert sorted(r.name for r in df.filter(case).collect()) == sorted(r.name for r in plain.filter(case).collect())
    reader = sqlite.SqliteReader({"path": str(folder), "table": "predicates"}, df.schema)
    from pyspark.sql.datasource import EqualTo, StringContains

    left = list(reader.pushFilters([EqualTo(("sense num",), 3), StringContains(("name",), "x"), EqualTo(("raw",), b"x")]))
    assert reader.where == ['("sense num" = ?)'] and reader.values == [3] and len(left) == 2


def test_tables_without_row_ids_and_missing_ones(spark, folder):
    keyed = sqlite.scan_sqlite(spark, str(folder), "keyed")
    assert keyed.count() == 40 and keyed.rdd.getNumPartitions() == 2
    assert sqlite.scan_sqlite(spark, str(folder), "none_yet").count() == 0
    with pytest.raises(Exception, match="no table absent"):
        sqlite.scan_sqlite(spark, str(folder), "absent").collect()
    with pytest.raises(Exception, match="no such column"):
        sqlite.scan_sqlite(spark, str(folder), "predicates", {"absent": "string"}).filter("absent = 'x'").collect()
