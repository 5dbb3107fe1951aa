"""Lines of files of any size, numbered within their file, and what can be read from them in ranges.

Spark cuts a large file into ranges and reads each by a task of its own; a line belongs to the range in which it begins. A first
pass counts the lines of each range, a running sum over a file's ranges gives each its first number, and the second pass adds to it
the line's place in its range. A file is never one row.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crosslink.scratch import written

#: Up to so many ranges (some 40 MB) their table is broadcast; beyond that lines are joined to it by path and range.
FEW_RANGES = 200_000


def relative(path: Column, root: str) -> Column:
    """A path below the root, whatever the scheme it was found by."""
    tail = re.sub(r"^[a-z0-9]+:/+", "/", root).rstrip("/") + "/"
    return F.substring_index(path, tail, -1)


def ranged_lines(spark: SparkSession, root: str, pattern: str = "*", keep: Callable[[Column], Column] | None = None, end: str = "\r") -> DataFrame:
    """path, block (where the line's range begins), at (increasing within a range, by 1 from line to line), text without ``end``. ``keep``: which lines count at all."""
    df = spark.read.format("text").option("lineSep", "\n").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    df = df.select(relative(F.col("_metadata.file_path"), root).alias("path"), F.col("_metadata.file_block_start").alias("block"), (F.regexp_replace("value", f"{end}$", "") if end else F.col("value")).alias("text"))
    if keep:
        df = df.filter(keep(F.col("text")))
    return df.withColumn("at", F.monotonically_increasing_id())


def block_table(lines: DataFrame) -> DataFrame:
    """path, block, first (at of its first line), n, opening (its first line), before (lines of the file before it), heading (the file's first line); a row for each range, written."""
    found = written(lines.groupBy("path", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"), F.min_by("text", "at").alias("opening")), "ranges")
    order = Window.partitionBy("path").orderBy("block")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return found.withColumns({"before": before, "heading": F.first("opening").over(order)})


def beside(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """``lines`` with the columns of their range."""
    few = blocks.select("path", "block").limit(FEW_RANGES + 1).count() <= FEW_RANGES
    return lines.join(F.broadcast(blocks) if few else blocks, ["path", "block"])


def numbered_lines(spark: SparkSession, root: str, pattern: str = "*", keep: Callable[[Column], Column] | None = None) -> DataFrame:
    """path, line (from 0, among the lines that are kept), text of all files below ``root`` whose name matches; zipped files are one range each.

    An empty file has no lines; a last line without a line break counts, an empty rest behind the last one does not.
    """
    lines = ranged_lines(spark, root, pattern, keep)
    blocks = block_table(lines).select("path", "block", (F.col("before") - F.col("first")).alias("shift"))
    return beside(lines, blocks).select("path", (F.col("at") + F.col("shift")).alias("line"), "text")


def cells(line: Column) -> Column:
    """The cells of a line of CSV; quoted ones may hold commas, a doubled quote is one quote."""
    quoted = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    bare = F.transform(quoted, lambda x: F.when(x.startswith('"'), F.replace(F.regexp_replace(x, '^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(x))
    return F.when(F.contains(line, F.lit('"')), bare).otherwise(F.split(line, ","))


def channel_lines(spark: SparkSession, root: str, channel: str, wanted: range, pattern: str = "*.csv") -> DataFrame:
    """path, line (from 0, without the header), values: the channels of each line in order of their numbers, each file's by its own header.

    ``channel``: a pattern whose first group is the channel's number. A file whose header doesn't name exactly the channels
    ``wanted`` raises with its path. Blank lines don't count; a cell that is missing or no number is null. An empty folder raises.
    """
    lines = ranged_lines(spark, root, pattern, lambda x: F.trim(x) != "")
    number = lambda x: F.regexp_extract(F.trim(x), f"^(?:{channel})$", 1).try_cast("int")
    named = F.filter(F.transform(cells(F.col("heading")), lambda x, i: F.struct(number(x).alias("number"), i.alias("place"))), lambda s: s["number"].isNotNull())
    blocks = block_table(lines).withColumn("named", F.array_sort(named))
    blocks = blocks.select("path", "block", (F.col("before") - F.col("first")).alias("shift"), F.col("named.number").alias("numbers"), F.col("named.place").alias("places"))
    right = F.col("numbers") == F.array(*[F.lit(i) for i in wanted])
    if bad := blocks.filter(~right).select("path", "numbers").distinct().limit(5).collect():
        raise ValueError("; ".join(f"{r.path} has the channels {r.numbers} where {list(wanted)} are wanted" for r in bad))
    if blocks.isEmpty():
        raise ValueError(f"no lines in {pattern} of {root}")
    out = beside(lines, blocks.drop("numbers")).withColumn("line", F.col("at") + F.col("shift") - 1).filter("line >= 0").withColumn("row", cells(F.col("text")))
    return out.select("path", "line", F.transform("places", lambda i: F.get("row", i).try_cast("double")).alias("values"))


_MARKS, _QUOTED = re.compile(r';[^\n]*|["()]'), re.compile(r'(?:[^"\\]|\\.)*', re.S)


def brackets(text: str, quoted: bool) -> Iterator[tuple[int, int, bool]]:
    """(place, 1 or -1, False) for each bracket outside strings and comments; at last (length, 0, whether the text ends in a string)."""
    at = 0
    while True:
        if quoted:
            at = _QUOTED.match(text, at).end() + 1  # behind the closing quote, or behind the end
            if at > len(text) or text[at - 1] != '"':
                yield len(text), 0, True
                return
            quoted = False
        m = _MARKS.search(text, at)
        if m is None:
            yield len(text), 0, False
            return
        at = m.end()
        if m[0] == '"':
            quoted = True
        elif m[0] in "()":
            yield m.start(), 1 if m[0] == "(" else -1, False


class Passage:
    """What some lines do to the reader of brackets that comes to them inside a string, or outside: depth d becomes max(d + rise, floor)."""

    def __init__(self):
        self.quoted, self.rise, self.floor = [False, True], [0, 0], [0, 0]

    def add(self, line: str) -> None:
        for i in (0, 1):
            for _, step, self_quoted in brackets(line + "\n", self.quoted[i]):
                if step:
                    self.rise[i] += step
                    self.floor[i] = max(self.floor[i] + step, 0)
                else:
                    self.quoted[i] = self_quoted


PASSAGES = "path string, block long, quoted array<boolean>, rise array<long>, floor array<long>"


def passages(lines: DataFrame) -> DataFrame:
    """path, block, quoted, rise, floor: the ``Passage`` of each range, in the task that reads it; some ranges may come from a task in parts."""
    import pandas as pd

    def run(batches):
        key, now = None, Passage()
        for batch in batches:
            for path, block, text in zip(batch["path"].tolist(), batch["block"].tolist(), batch["text"].tolist()):
                if (path, block) != key:
                    if key:
                        yield pd.DataFrame([(*key, now.quoted, now.rise, now.floor)], columns=["path", "block", "quoted", "rise", "floor"])
                    key, now = (path, block), Passage()
                now.add(text)
        if key:
            yield pd.DataFrame([(*key, now.quoted, now.rise, now.floor)], columns=["path", "block", "quoted", "rise", "floor"])

    return lines.select("path", "block", "text").mapInPandas(run, PASSAGES)


def entered(found: DataFrame) -> DataFrame:
    """path, block, depth, quoted: how a reader that began at the file's first line comes to each range. Passages follow each other in one aggregate over a file's ranges, which are few."""
    step = F.struct("block", "quoted", "rise", "floor")
    start = F.struct(F.lit(0).cast("long").alias("depth"), F.lit(False).alias("quoted"), F.array().cast("array<struct<block:bigint,depth:bigint,quoted:boolean>>").alias("seen"))

    def follow(state: Column, x: Column) -> Column:
        i = F.when(state["quoted"], 1).otherwise(0)
        here = F.struct(x["block"].alias("block"), state["depth"].alias("depth"), state["quoted"].alias("quoted"))
        return F.struct(F.greatest(state["depth"] + F.get(x["rise"], i), F.get(x["floor"], i)).alias("depth"), F.get(x["quoted"], i).alias("quoted"), F.concat(state["seen"], F.array(here)).alias("seen"))

    files = found.groupBy("path").agg(F.array_sort(F.collect_list(step)).alias("steps"))
    seen = files.select("path", F.explode(F.aggregate("steps", start, follow)["seen"]).alias("s"))
    return seen.select("path", "s.block", "s.depth", "s.quoted")


def fragments_of(text: str, depth: int, quoted: bool) -> Iterator[tuple[bool, bool, int, int]]:
    """(begins, ends, from, to): the top-level formulas in some lines, and the parts of those that reach over their first or last line."""
    begin = 0 if depth else None
    opened = False
    for at, step, _ in brackets(text, quoted):
        if step == 1:
            if depth == 0:
                begin, opened = at, True
            depth += 1
        elif step == -1 and depth:
            depth -= 1
            if depth == 0:
                yield opened, True, begin, at + 1
                begin = None
    if begin is not None:
        yield opened, False, begin, len(text)


FRAGMENTS = "path string, block long, place int, line long, begins boolean, ends boolean, text string"


def formulas(spark: SparkSession, root: str, pattern: str = "*.kif") -> DataFrame:
    """path, formula_index and start_line (from 1), formula: the text of each top-level formula of axiom files of any size.

    Where strings and brackets stand open at the beginning of a range follows from what each range before does to them. A formula
    belongs to the range in which it begins, parts in later ranges are put to it; what stays open at the end of a file is left out,
    and so is a closing bracket too many. Ranges of a file meet in one group each, formulas over several ranges likewise.
    """
    import pandas as pd

    lines = ranged_lines(spark, root, pattern, end="")
    blocks = block_table(lines)
    states = entered(passages(lines)).join(blocks.select("path", "block", "before"), ["path", "block"])

    def cut(key: tuple, rows: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        text, start = "\n".join(rows.sort_values("at")["text"]), state.iloc[0]
        found = [(*key, i, int(start["before"]) + text.count("\n", 0, a) + 1, begins, ends, text[a:b]) for i, (begins, ends, a, b) in enumerate(fragments_of(text, int(start["depth"]), bool(start["quoted"])))]
        return pd.DataFrame(found, columns=["path", "block", "place", "line", "begins", "ends", "text"])

    parts = written(lines.groupBy("path", "block").cogroup(states.groupBy("path", "block")).applyInPandas(cut, FRAGMENTS), "formulas")
    counts = parts.groupBy("path", "block").agg(F.count_if("begins").alias("n"), F.max(F.when(F.col("begins") & ~F.col("ends"), F.col("place"))).alias("last"))
    order = Window.partitionBy("path").orderBy("block")
    counts = counts.select("path", "block", F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("earlier"), F.last(F.when(F.col("last").isNotNull(), F.col("block")), True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("since"))
    parts = parts.join(counts, ["path", "block"])
    first = parts.filter("begins").withColumn("formula_index", F.col("earlier") + F.row_number().over(Window.partitionBy("path", "block").orderBy("place")))
    whole = first.filter("ends").select("path", "formula_index", F.col("line").alias("start_line"), F.col("text").alias("formula"))
    opened = first.filter("not ends").select("path", F.col("block").alias("since"), "formula_index", "line", F.col("text").alias("opening"))
    later = parts.filter("not begins").groupBy("path", "since").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]), "\n").alias("rest"), F.bool_or("ends").alias("closed"))
    over = opened.join(later.filter("closed"), ["path", "since"]).select("path", "formula_index", F.col("line").alias("start_line"), F.concat_ws("\n", "opening", "rest").alias("formula"))
    return whole.unionByName(over)
