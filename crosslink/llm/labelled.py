"""Bounded, repeatable samples of labelled texts for the classifiers."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crosslink.llm.common import held_out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, megabytes: int = 32) -> tuple[list[bytes], list[int], float]:
    """Texts (UTF-8), labels (0 or 1) and the log odds of label 1 among all labelled rows that may be learned from.

    At most ``per_class`` rows of each class, ``megabytes`` of text a class at most: those with the least hash of their id, a bounded
    set that is sent to the driver. Whole texts are taken; those that would go over the bound are not.
    Rows whose crc32(doc_id as text) mod 5 is 0, null ids and labels other than 0 and 1 are never learned from; a null text
    counts as empty. Without any row the log odds are 0.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter("doc_id is not null and label in (0, 1)").filter(~held_out())
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    prior = math.log((counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5))
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = known.filter("label = 0").orderBy(*order).limit(per_class).unionByName(known.filter("label = 1").orderBy(*order).limit(per_class))
    # at most 2 x per_class ids
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
    upto = F.sum(F.octet_length("text")).over(W.partitionBy("label").orderBy(*order, "text").rowsBetween(W.unboundedPreceding, W.currentRow))
    rows = found.withColumn("upto", upto).filter(F.col("upto") <= megabytes << 20).select("doc_id", "text", "label").toArrow()
    rows = rows.sort_by([(c, "ascending") for c in ("doc_id", "text", "label")])
    return [x.as_buffer().to_pybytes() for x in rows["text"]], rows["label"].to_pylist(), prior
