"""Sets of tables that are published together: staged in a folder of their own, then named by one manifest whose rename is the commit."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from crosslink.operators.metrics import digest_of

MANIFEST = "manifest.json"


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _exists(spark: SparkSession, path: str) -> bool:
    files, place = _files(spark, path)
    return files.exists(place)


def publish(tables: dict[str, DataFrame], path: str, about: dict[str, str] | None = None, check: Callable[[dict[str, DataFrame]], DataFrame] | None = None) -> dict:
    """Writes all tables and then the manifest that names them; returns it. A path that has a manifest is refused.

    Each table goes to a new folder below ``path``; its rows are counted and digested by the job that writes them. ``check`` gets the
    staged tables and returns violations; if it finds any, or a table fails, what was staged is removed and nothing has been
    published: a reader sees all tables of a set or none.
    """
    spark = next(iter(tables.values())).sparkSession
    root = path.rstrip("/")
    if _exists(spark, f"{root}/{MANIFEST}"):
        raise FileExistsError(f"{root} holds a published set")
    data = f"data-{uuid.uuid4().hex}"
    try:
        entries = {}
        for name, df in tables.items():
            seen = Observation()
            df.observe(seen, F.count(F.lit(1)).alias("rows"), digest_of(*df.columns).alias("digest")).write.parquet(f"{root}/{data}/{name}")
            entries[name] = {"rows": seen.get["rows"], "digest": seen.get["digest"], "columns": [f"{c} {kind}" for c, kind in df.dtypes]}
        manifest = {"about": about or {}, "data": data, "tables": entries}
        if check is not None and (bad := check(_tables(spark, root, manifest)).limit(5).collect()):
            raise ValueError(f"{root} is not published: {[tuple(b) for b in bad]}")
        staged = f"{root}/.{MANIFEST}-{uuid.uuid4().hex}"
        files, place = _files(spark, staged)
        out = files.create(place, False)
        out.write(bytearray(json.dumps(manifest, sort_keys=True), "utf-8"))
        out.close()
        if _exists(spark, f"{root}/{MANIFEST}") or not files.rename(place, _files(spark, f"{root}/{MANIFEST}")[1]):
            files.delete(place, False)
            raise FileExistsError(f"{root} was published meanwhile")
        return manifest
    except BaseException:
        files, place = _files(spark, f"{root}/{data}")
        files.delete(place, True)
        raise


def manifest_of(spark: SparkSession, path: str) -> dict:
    if not _exists(spark, f"{path.rstrip('/')}/{MANIFEST}"):
        raise FileNotFoundError(f"{path} holds no published set")
    return json.loads(spark.read.option("wholetext", "true").text(f"{path.rstrip('/')}/{MANIFEST}").first().value)


def _tables(spark: SparkSession, path: str, manifest: dict) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path.rstrip('/')}/{manifest['data']}/{name}") for name in manifest["tables"]}


def read_set(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables that the manifest names."""
    return _tables(spark, path, manifest_of(spark, path))


def set_counts(spark: SparkSession, path: str) -> DataFrame:
    """asset, rows of each table, as they were counted when it was written; no table is read."""
    return spark.createDataFrame([(name, e["rows"]) for name, e in manifest_of(spark, path)["tables"].items()], "asset string, rows long")


def set_violations(spark: SparkSession, path: str) -> DataFrame:
    """asset, code, detail where a set differs from its manifest: MISSING and UNEXPECTED tables, COLUMNS, ROWS, DIGEST. Each table is read once; the digest does not depend on the order of rows."""
    manifest = manifest_of(spark, path)
    files, place = _files(spark, f"{path.rstrip('/')}/{manifest['data']}")
    there = {s.getPath().getName() for s in files.listStatus(place) if s.isDirectory()} if files.exists(place) else set()
    entries = manifest["tables"]
    known = [(n, "MISSING", n) for n in sorted(set(entries) - there)] + [(n, "UNEXPECTED", n) for n in sorted(there - set(entries))]
    parts = []
    for name in sorted(there & set(entries)):
        df, entry = spark.read.parquet(f"{path.rstrip('/')}/{manifest['data']}/{name}"), entries[name]
        if (columns := [f"{c} {kind}" for c, kind in df.dtypes]) != entry["columns"]:
            known.append((name, "COLUMNS", ", ".join(columns)))
            continue
        facts = df.agg(F.count(F.lit(1)).alias("rows"), digest_of(*df.columns).alias("digest"))
        rows = F.when(F.col("rows") != entry["rows"], F.struct(F.lit("ROWS").alias("code"), F.concat(F.lit(f"{entry['rows']} declared, "), F.col("rows").cast("string"), F.lit(" there")).alias("detail")))
        digest = F.when(F.col("digest") != entry["digest"], F.struct(F.lit("DIGEST").alias("code"), F.col("digest").alias("detail")))
        parts.append(facts.select(F.lit(name).alias("asset"), F.explode(F.array_compact(F.array(rows, digest))).alias("v")).select("asset", "v.code", "v.detail"))
    return reduce(DataFrame.unionByName, parts, spark.createDataFrame(known, "asset string, code string, detail string"))
