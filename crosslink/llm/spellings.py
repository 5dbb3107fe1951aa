"""Spelling variants: words one edit apart, found by sorting permuterm rotations.

A word with a mark at its end has a rotation for each place: ``b$a`` for a cut ``a|b``. Words that differ by a replaced character
x, ``a x b``, are the rotations ``b$a`` + x, and the word without it, ``a b``, is the rotation ``b$a`` itself. So all rotations,
less their last character where that is the edited one, are sorted; those of one prefix are a group, and each member's neighbours
are the others. A group has as many members as the alphabet has characters, and one more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crosslink.llm.common import remove, write

#: What a word is made of, and the letters that are lower-cased.
RUN, UPPER, LOWER = r"[A-Za-zÀ-ÿ]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARK = "$"


def counted_words(docs: DataFrame, slip: int | None = None, shortest: int = 5, rarest: int = 3) -> DataFrame:
    """word, n: lower-cased runs of letters of all texts that have ``shortest`` code points and ``rarest`` occurrences at least.

    With ``slip``, a run loses the code point h % length where h, the crc32 of ``<doc_id>:<run>``, is divisible by it: typing
    errors whose place is known. Null texts have no words; a null doc_id counts as an empty one. Words are counted in the tasks that
    read them before they are shuffled, so a frequent word is no hot key.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run")).filter(F.length("run") >= shortest)
    runs = runs.select("doc_id", F.translate("run", UPPER, LOWER).alias("word"))
    if slip:
        h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "word").cast("binary"))
        runs = runs.withColumn("h", h)
        runs = runs.withColumn("word", F.when(F.col("h") % slip == 0, F.overlay("word", F.lit(""), (F.col("h") % F.length("word") + 1).cast("int"), F.lit(1))).otherwise(F.col("word")))
        runs = runs.filter(F.length("word") >= shortest)
    return runs.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= rarest)


def rotations(words: DataFrame) -> DataFrame:
    """prefix, word, n, edited, leads: each rotation, and each one less its last character (edited) if that isn't the mark.

    leads: the edited character is not the same as the one before it. Words of equal characters in a row give one shorter word
    in several ways; only the first of these counts as its deletion.
    """

    def rotated(cut: Column, skip: int) -> Column:
        return F.concat(F.substring("word", cut + 1 + skip, F.length("word")), F.lit(MARK), F.substring("word", F.lit(1), cut))

    def cuts(last: Column, skip: int, edited: bool) -> Column:
        leads = lambda i: (i == 0) | (F.substring("word", i, F.lit(1)) != F.substring("word", i + 1, F.lit(1))) if edited else F.lit(False)
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(rotated(i, skip).alias("prefix"), F.lit(edited).alias("edited"), leads(i).alias("leads")))

    whole, shorter = cuts(F.length("word"), 0, False), cuts(F.length("word") - 1, 1, True)
    every = F.when(F.length("word") > 0, F.concat(whole, shorter)).otherwise(whole)
    return words.select("word", "n", F.explode(every).alias("r")).select("r.prefix", "word", "n", "r.edited", "r.leads")


def neighbours(words: DataFrame) -> DataFrame:
    """word, near (how many other words are one edit away), best (struct of -n and word: the most frequent of them, of equals the smallest) for the words that have any.

    Rotations are sorted by prefix, in a group by falling n, and scanned once; a pair of words shares one group alone.
    """
    group = Window.partitionBy("prefix").orderBy(F.desc("n"), "word").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own = F.struct((-F.col("n")).alias("less"), "word")
    first = lambda rows, k=1: F.nth_value(F.when(rows, own), k, True).over(group)
    edited, leads, whole = F.col("edited"), F.col("leads"), ~F.col("edited")
    scanned = rotations(words).select(
        "word", "n", "edited", "leads", first(edited).alias("top"), first(edited, 2).alias("next"), first(leads).alias("longer"), first(whole).alias("shorter"),
        F.count(F.when(edited, 1)).over(group).alias("all"), F.count(F.when(leads, 1)).over(group).alias("leading"),
    )
    replaced = F.when(F.col("top.word") == F.col("word"), F.col("next")).otherwise(F.col("top"))
    cut = F.when(leads, F.col("shorter"))
    near = F.when(edited, F.col("all") - 1 + F.when(cut.isNotNull(), 1).otherwise(0)).otherwise(F.col("leading"))
    best = F.when(edited, F.least(replaced, cut)).otherwise(F.col("longer"))
    return scanned.select("word", near.alias("near"), best.alias("best")).filter("near > 0")


def roots(forms: DataFrame) -> DataFrame:
    """word, form (no null, no circle) -> word, root: the last form that can be reached. Each round doubles the way, so rounds are few."""
    (now, path) = write(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        (new, to) = write(now.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("went")), "forms")
        remove(forms.sparkSession, path)
        now, path = new.drop("went"), to
        if new.filter("went").isEmpty():
            return now


def variants(words: DataFrame, factor: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n of each row of ``words`` (word, n; words are distinct and hold no ``$``).

    Two words are near if they differ by one inserted, deleted or replaced code point. form is the near word of largest n (ties: the
    smallest in code-point order) if that n is at least ``factor`` (over 1) times the word's own; root follows forms to the last one,
    and is the word itself if it has none. Null words are left out; an empty word is near to words of one character; a word with
    ``$`` raises, as its rotations would be ambiguous. An empty table gives no rows.
    """
    if factor <= 1:
        raise ValueError("a factor of 1 or less would let forms go in circles")
    bad = F.raise_error(F.concat(F.lit("a word holds the mark: "), "word"))
    words, _ = write(words.filter("word is not null").select(F.when(F.contains("word", F.lit(MARK)), bad).otherwise(F.col("word")).alias("word"), F.col("n").cast("long").alias("n")), "words")
    alone = words.select("word", "n", F.lit(0).cast("long").alias("near"), F.lit(None).cast("struct<less bigint, word string>").alias("best"))
    every = alone.unionByName(neighbours(words).withColumn("n", F.lit(None).cast("long")))
    every = every.groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best"))
    far = -F.col("best.less") >= factor * F.col("n")
    every = every.select("word", "n", "n_near", F.when(far, F.col("best.word")).alias("form"), F.when(far, -F.col("best.less")).alias("form_n"))
    every, _ = write(every, "variants")
    out = every.join(roots(every.filter("form is not null")), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
