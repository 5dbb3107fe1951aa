"""Files, JSON lines, samples, channels, paths."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from crosslink.scratch import written
from crosslink.sources.lines import channel_lines, numbered_lines, relative


def scan_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path (below the root), length, sha256 of the files that match; raises if there are none."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    out = found.select(relative(F.col("path"), root).alias("path"), "length", F.sha2("content", 256).alias("sha256"))
    if found.select("path").isEmpty():
        raise ValueError(f"no file matches {pattern} in {root}")
    return out


def whole_texts(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """path, text of whole files."""
    df = spark.read.format("text").option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return df.select(relative(F.col("_metadata.file_path"), root).alias("path"), F.col("value").alias("text"))


def scan_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Typed JSON lines, plain or gzipped; a bad line ends the read. Fields that the schema lacks are dropped at every level."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def bad_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """path, line (from 1), text of lines that aren't rows of the schema. Lines of a large file are numbered by ranges."""
    lines = numbered_lines(spark, path).filter("trim(text) <> ''")
    parsed = F.from_json("text", f"{schema}, __bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})
    return lines.withColumn("r", parsed).filter("r is null or r.__bad is not null").select("path", (F.col("line") + 1).alias("line"), "text")


def jsonl_or_fail(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """``scan_jsonl``, if all lines are rows of the schema; else raises with file and number of the first lines that are not."""
    bad = bad_json_lines(spark, path, schema).orderBy("path", "line").limit(5).collect()
    if bad:
        raise ValueError("no rows of the schema: " + ", ".join(f"{r['path']} line {r['line']}" for r in bad))
    return scan_jsonl(spark, path, schema)


def scan_table(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """A Parquet table that has the required columns; raises with the missing ones."""
    df = spark.read.parquet(path)
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"{path} lacks {', '.join(missing)}")
    return df


def scan_samples(spark: SparkSession, root: str, columns: list[str], pattern: str = "*") -> DataFrame:
    """path, sample_index and doubles from lines of blank-separated numbers; the order of lines that aren't blank is kept as the index."""
    lines = numbered_lines(spark, root, pattern, lambda x: F.trim(x) != "")
    parts = F.split(F.trim("text"), r"\s+")
    return lines.select("path", F.col("line").alias("sample_index"), *[F.get(parts, i).try_cast("double").alias(c) for i, c in enumerate(columns)])


def scan_channels(spark: SparkSession, path: str, pattern: str, wanted: range, drop: int | None = None, reverse: bool = False, files: str = "*") -> DataFrame:
    """path, line, total: the sum of the chosen channels of a CSV line; null if one isn't a finite number.

    Each file's channels stand where its own header says; see ``channel_lines``. ``files``: a pattern of their names. ``drop``: a channel that counts as 0, but must be a
    finite number like the others. ``reverse``: channels in reverse order, which must not change the sum but for rounding.
    """
    values = F.reverse("values") if reverse else F.col("values")
    finite = F.forall("values", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    place = None if drop is None else wanted.index(drop) if not reverse else len(wanted) - 1 - wanted.index(drop)
    kept = values if place is None else F.transform(values, lambda x, i: F.when(i == place, 0.0).otherwise(x))
    total = F.aggregate(kept, F.lit(0.0), lambda a, x: a + x)
    return channel_lines(spark, path, pattern, wanted, files).select("path", "line", F.when(finite, total).alias("total"))


def decompose_paths(df: DataFrame, path: str, pattern: str, names: list[str], keep: dict[str, list[str]]) -> DataFrame:
    """``df`` with the groups of a pattern as columns, for the paths that match and whose parts are among the kept ones."""
    out = df.filter(F.col(path).rlike(pattern)).withColumns({n: F.regexp_extract(path, pattern, i) for i, n in enumerate(names, 1)})
    for name, values in keep.items():
        out = out.filter(F.col(name).isin(*values))
    return out


def excluded_paths(every: DataFrame, selected: DataFrame) -> DataFrame:
    return every.select("path").distinct().join(selected.select("path").distinct(), "path", "left_anti").orderBy("path")


def write_table(df: DataFrame, path: str, check=None) -> None:
    """Writes a table that must not exist yet: staged beside its place, checked, then renamed. ``check``: DataFrame -> violations."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    target, stage = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.staged")
    fs = target.getFileSystem(conf)
    if fs.exists(target):
        raise FileExistsError(path)
    df.write.mode("overwrite").parquet(stage.toString())
    if check is not None and (bad := check(df.sparkSession.read.parquet(stage.toString())).limit(5).collect()):
        fs.delete(stage, True)
        raise ValueError(f"{path} is not written: {bad}")
    if not fs.rename(stage, target):
        raise OSError(f"{path} can't be put in place")


def resume(rows: DataFrame, checkpoint: str, key: str, process) -> DataFrame:
    """Processes the rows whose key the checkpoint table lacks, appends them to it once, and returns the table."""
    spark = rows.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(checkpoint)
    there = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
    todo = rows.join(spark.read.parquet(checkpoint).select(key), key, "left_anti") if there else rows
    process(todo.dropDuplicates([key])).write.mode("append").parquet(checkpoint)
    return spark.read.parquet(checkpoint)


def attempt(df: DataFrame, process: Callable[[dict], dict], schema: str, most: int = 2000) -> DataFrame:
    """``df`` with the fields of ``schema`` that ``process`` makes of each row, error_type and error_message (cut to ``most``): a row whose processing raises keeps its own columns, has no result, and the others go on."""
    own, fields = df.schema, T.StructType.fromDDL(schema)
    every = T.StructType([*own.fields, *[T.StructField(f.name, f.dataType) for f in fields], T.StructField("error_type", T.StringType()), T.StructField("error_message", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(fields)
        for batch in batches:
            made, types, messages = [], [], []
            for row in batch.to_pylist():
                try:
                    made.append(process(row))
                    types.append(None)
                    messages.append(None)
                except Exception as e:  # what failed is a row of the result
                    made.append({})
                    types.append(type(e).__name__)
                    messages.append(str(e)[:most])
            columns = [pa.array([m.get(f.name) for m in made], f.type) for f in kinds]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns, pa.array(types, pa.string()), pa.array(messages, pa.string())], names=every.names)

    return df.mapInArrow(run, every)


def dead_letter(df: DataFrame, error: str, most: int = 2000, path: str | None = None, keys: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(good rows, failed rows with their message cut to ``most``, counts attempted / completed / failed).

    ``df`` is worked out once, written and counted in one job, so good and failed rows add up even if its errors don't come the same
    way twice. With ``path``, the failed rows (columns ``keys`` and the message; all, without them) are appended as lines of JSON.
    """
    failed, seen = F.col(error).isNotNull(), Observation()
    counted = [F.count(F.lit(1)).alias("attempted"), F.count_if(~failed).cast("long").alias("completed"), F.count_if(failed).cast("long").alias("failed")]
    done = written(df.observe(seen, *counted), "attempted")
    good = done.filter(~failed).drop(error)
    bad = done.filter(failed).withColumn(error, F.left(error, F.lit(most)))
    if path:
        bad.select(*(keys or [c for c in bad.columns if c != error]), error).write.mode("append").json(path)
    return good, bad, df.sparkSession.createDataFrame([tuple(seen.get[n] for n in ("attempted", "completed", "failed"))], "attempted long, completed long, failed long")
