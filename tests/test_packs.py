import pytest
from pyspark.sql import functions as F

from crosslink.operators import checks
from crosslink.sources import packs


def frames(spark):
    return {"a": spark.range(10).withColumn("x", F.col("id") * 0.5), "b": spark.createDataFrame([("k", [1, 2]), (None, None)], "k string, v array<int>")}


def found(df):
    return {(r.asset, r.code) for r in df.collect()}


def test_publish_and_read(spark, tmp_path):
    path, tables = str(tmp_path / "p"), frames(spark)
    manifest = packs.publish(tables, path, {"version": "1"})
    assert {n: e["rows"] for n, e in manifest["tables"].items()} == {"a": 10, "b": 2} and packs.manifest_of(spark, path) == manifest
    read = packs.read_set(spark, path)
    assert all(read[n].exceptAll(tables[n]).isEmpty() and tables[n].exceptAll(read[n]).isEmpty() for n in tables)
    assert {tuple(r) for r in packs.set_counts(spark, path).collect()} == {("a", 10), ("b", 2)} and packs.set_violations(spark, path).isEmpty()
    with pytest.raises(FileExistsError):
        packs.publish(tables, path)
    assert packs.manifest_of(spark, path) == manifest


def test_failures_leave_nothing(spark, tmp_path):
    """A table that fails after another was written, and a check that finds something: no reader sees the first table."""
    path, tables = str(tmp_path / "p"), frames(spark)
    broken = tables["a"].withColumn("x", F.raise_error(F.lit("halfway")))
    with pytest.raises(Exception, match="halfway"):
        packs.publish({"a": tables["a"], "b": broken}, path)
    with pytest.raises(ValueError, match="not published"):
        packs.publish(tables, path, check=lambda staged: staged["a"].filter("id = 3"))
    with pytest.raises(FileNotFoundError):
        packs.read_set(spark, path)
    assert [p.name for p in (tmp_path / "p").iterdir() if p.name.startswith("data")] == []
    packs.publish(tables, path, check=lambda staged: staged["a"].filter("id > 30"))
    assert packs.read_set(spark, path)["b"].count() == 2


def test_changes_are_seen(spark, tmp_path):
    path, tables = str(tmp_path / "p"), frames(spark)
    tables |= {"c": tables["a"], "d": tables["a"]}
    data = f"{path}/{packs.publish(tables, path)['data']}"
    tables["a"].repartition(7).write.mode("overwrite").parquet(f"{data}/a")  # other order, same rows
    assert packs.set_violations(spark, path).isEmpty()
    tables["a"].withColumn("x", F.col("x") + (F.col("id") == 3).cast("int")).write.mode("overwrite").parquet(f"{data}/a")
    tables["b"].write.mode("append").parquet(f"{data}/b")
    tables["a"].drop("x").write.mode("overwrite").parquet(f"{data}/c")
    spark._jvm.org.apache.hadoop.fs.FileUtil.fullyDelete(spark._jvm.java.io.File(f"{data}/d"))
    tables["a"].write.parquet(f"{data}/e")
    assert found(packs.set_violations(spark, path)) == {("a", "DIGEST"), ("b", "ROWS"), ("b", "DIGEST"), ("c", "COLUMNS"), ("d", "MISSING"), ("e", "UNEXPECTED")}


def pack(spark, **other):
    frame = spark.createDataFrame
    maps = "canonical_id string, canonical_kind string, source_key string, source_id string, relation string"
    rows = [("p1", "predicate_type", "donor", "1", "derived_from"), ("p2", "predicate_type", "donor", "2", "derived_from"), ("p1:r", "role_slot", "donor", "1:0", "positional_role"), ("t1", "entity_type", "sumo_types", "T", "typed_by"), ("t1", "entity_type", "sumo_types", "T", "typed_by"), ("t1:subtype_of:t2", "hierarchy_edge", "sumo_types", "x", "subtype_of"), ("p1", "predicate_type", "propbank", "s.01", "derived_from"), ("p1", "predicate_type", "framenet_candidate", "f", "candidate_alignment")]
    tables = {
        "predicate_types": frame([("p1",), ("p2",)], "predicate_id string"), "predicate_role_edges": frame([("p1", "r")], "predicate_id string, role_id string"), "entity_types": frame([("t1",), ("t2",)], "type_id string"),
        "hierarchy_edges": frame([("t1", "t2")], "child_id string, parent_id string"), "constraints": frame([("p1", "r", "t1"), ("p1", "q", "t1"), ("p2", "r", "t1"), ("p2", "s", None)], "predicate_id string, role_id string, expected_type string"),
        "source_mappings": frame([("p1", "predicate_type", "propbank", "s.01", "derived_from"), ("p1", "predicate_type", "other", "z", "derived_from")], "canonical_id string, canonical_kind string, source_system string, source_id string, mapping_type string"),
        "semantic_mappings": frame(rows, maps),
    }
    return tables | {k: f(tables[k]) for k, f in other.items()}


SOURCES = ["donor", "propbank", "sumo_types", "framenet_candidate"]


def test_provenance_of_a_pack(spark):
    codes = lambda **other: {(r.code, r.detail) for r in checks.pack_violations(pack(spark, **other), SOURCES, {"framenet_candidate": 1}).collect()}
    assert codes() == set()
    without = lambda text: lambda df: df.filter(~F.expr(text))
    twice = lambda text: lambda df: df.unionByName(df.filter(text))
    assert codes(semantic_mappings=without("canonical_id = 'p2'")) == {("PREDICATE_NOT_COVERED", "p2")}
    assert codes(semantic_mappings=twice("canonical_kind = 'role_slot'")) == {("ROLE_BAG", "p1:r")}
    assert codes(semantic_mappings=without("canonical_kind = 'role_slot'")) == {("ROLE_BAG", "p1:r")}
    assert codes(semantic_mappings=twice("canonical_kind = 'hierarchy_edge' or source_id = '1'")) == set()  # sets, not bags
    assert codes(semantic_mappings=without("canonical_kind = 'hierarchy_edge'")) == {("HIERARCHY_NOT_COVERED", "t1:subtype_of:t2")}
    assert codes(semantic_mappings=lambda df: df.dropDuplicates()) == {("TYPE_BAG", "t1")}
    assert codes(source_mappings=twice("source_system = 'propbank'")) == {("SENSE_BAG", "p1|predicate_type|s.01|derived_from")}
    assert codes(semantic_mappings=twice("source_key = 'framenet_candidate'")) == {("COUNT", "framenet_candidate 2 1")}
    assert codes(semantic_mappings=lambda df: df.withColumn("source_key", F.when(F.col("source_id") == "f", "new").otherwise(F.col("source_key")))) == {("UNDECLARED_SOURCE", "new"), ("COUNT", "framenet_candidate 0 0")}
    assert codes(entity_types=without("type_id = 't1'")) == {("DANGLING_ENTITY_TYPE", "t1")}
    assert codes(predicate_role_edges=lambda df: df.withColumn("role_id", F.lit("z"))) == {("DANGLING_ROLE_SLOT", "p1:r"), ("ROLE_BAG", "p1:r"), ("ROLE_BAG", "p1:z")}
