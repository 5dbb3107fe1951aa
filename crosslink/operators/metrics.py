"""Counts, coverage, confusion with refusal, rank correlation, factors and digests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crosslink.operators.windows import max_gap
from crosslink.functions.values import band, ratio
from crosslink.scratch import written


def n_if(condition: Column) -> Column:
    return F.count_if(condition).cast("long")


def status_counts(df: DataFrame, by: list[str], column: str, values: list[str]) -> DataFrame:
    """by, n_<value> for each value, zero where it doesn't occur, and n_total."""
    return df.groupBy(*by).agg(*[n_if(F.col(column) == v).alias(f"n_{v}") for v in values], F.count("*").alias("n_total"))


def identity_coverage(compared: DataFrame, sources: DataFrame) -> DataFrame:
    """family, source_ids, donor_ids, matched, missing, invalid, unavailable, extra, donor_digest.

    compared: family, donor_id, normal_id, status. extra: source ids that no donor matched. The digest doesn't depend on order.
    """
    ids = compared.select("family", "donor_id", "normal_id", "status").distinct()
    donor = ids.groupBy("family").agg(
        F.count_distinct("donor_id").alias("donor_ids"),
        *[n_if(F.col("status") == s).alias(n) for s, n in (("matched", "matched"), ("missing", "missing"), ("invalid", "invalid"), ("source_unavailable", "unavailable"))],
        F.count_distinct(F.when(F.col("status") == "matched", F.col("normal_id"))).alias("__hit"),
        digest_of("donor_id").alias("donor_digest"),
    )
    source = sources.groupBy("family").agg(F.count_distinct("source_id").alias("source_ids"))
    out = donor.join(source, "family", "full_outer")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select("family", *[zero(c).alias(c) for c in ("source_ids", "donor_ids", "matched", "missing", "invalid", "unavailable")], (zero("source_ids") - zero("__hit")).alias("extra"), "donor_digest")


def digest_of(*columns: str) -> Column:
    """An aggregate that equal multisets of rows share: the sum of 56-bit row hashes and the count, so no row list is gathered."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in columns])
    part = F.conv(F.substring(F.sha2(text, 256), 1, 14), 16, 10).cast("decimal(38,0)")
    return F.concat_ws("-", F.count("*").cast("string"), F.sum(part).cast("string"))


def content_digest(df: DataFrame, columns: list[str]) -> DataFrame:
    """rows, digest of a table, whatever the order of its rows."""
    return df.agg(F.count("*").alias("rows"), digest_of(*columns).alias("digest"))


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """asset, rows of each table."""
    return reduce(DataFrame.unionByName, [t.agg(F.count("*").alias("rows")).select(F.lit(n).alias("asset"), "rows") for n, t in tables.items()])


def source_coverage(projections: dict[str, tuple[DataFrame, DataFrame]], repaired: DataFrame | None = None) -> DataFrame:
    """source, files, parsed, issues, repairs, complete for each source's files (path, parsed) and issues (path); repaired: source, path.

    complete needs that each file is parsed or has an issue, and no file both.
    """
    parts = []
    for name, (found, issues) in projections.items():
        bad = issues.select("path").distinct().withColumn("__bad", F.lit(True))
        f = found.join(bad, "path", "left").agg(F.count("*").alias("files"), n_if(F.col("parsed")).alias("parsed"), n_if(F.col("__bad")).alias("issues"), n_if(F.col("parsed") != F.coalesce("__bad", F.lit(False))).alias("__fine"))
        parts.append(f.select(F.lit(name).alias("source"), "files", "parsed", "issues", (F.col("files") == F.col("__fine")).alias("complete")))
    out = reduce(DataFrame.unionByName, parts)
    repaired = out.select("source").filter("false") if repaired is None else repaired
    n = repaired.groupBy("source").agg(F.count("*").alias("repairs"))
    return out.join(n, "source", "left").select("source", "files", "parsed", "issues", F.coalesce("repairs", F.lit(0)).cast("long").alias("repairs"), "complete")


def inventory_check(inventory_: DataFrame, evidence: DataFrame) -> DataFrame:
    """asset, selected, available, evidence, ok: selected must not exceed what is available, and both must equal the evidence table's."""
    e = evidence.select("asset", F.col("selected").alias("__s"), F.col("available").alias("__a"))
    ok = (F.col("selected") <= F.col("available")) & F.col("selected").eqNullSafe(F.col("__s")) & F.col("available").eqNullSafe(F.col("__a"))
    return inventory_.join(e, "asset", "left").select("asset", "selected", "available", F.coalesce(ok, F.lit(False)).alias("ok"))


def distinct_labels(df: DataFrame, key: str, label: str) -> DataFrame:
    return df.groupBy(key).agg(F.array_sort(F.collect_set(label)).alias("labels"))


def first_witness(refs: DataFrame, preferred: str) -> DataFrame:
    """term, ref: one reference for each term: declarations before uses, the preferred module first, then path and index.

    refs: term, is_declaration, module, path, idx, ref.
    """
    order = F.struct(~F.col("is_declaration"), F.col("module") != preferred, "path", "idx")
    return refs.groupBy("term").agg(F.min_by("ref", order).alias("ref"))


def term_inventory(families: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """term, n_refs, refs (sorted "path#idx") over all families of axioms; each: (table with path and idx, its term columns)."""
    parts = [df.select(F.col(c).alias("term"), F.col("path"), F.col("idx")) for df, cols in families.values() for c in cols]
    refs = reduce(DataFrame.unionByName, parts).filter("term is not null").distinct()
    return refs.groupBy("term").agg(F.count("*").alias("n_refs"), F.array_sort(F.collect_set(F.concat_ws("#", "path", F.lpad(F.col("idx").cast("string"), 9, "0")))).alias("refs"))


def confusion(df: DataFrame, reference: str, prediction: str, classes: list[str]) -> DataFrame:
    """reference, n_<class> for each predicted class (refusal among them), n_total."""
    return status_counts(df.withColumnRenamed(reference, "reference"), ["reference"], prediction, classes)


def refusal_metrics(reference: Column, prediction: Column, positive: str, negative: str, refused: str = "refused") -> list[Column]:
    """Aggregates: n, coverage, accuracy (a refusal is wrong), covered_accuracy, balanced_accuracy (null without both classes), false_positives, false_negatives, refusals."""
    right, covered = reference == prediction, prediction != refused
    side = lambda c: ratio(n_if((reference == c) & right), n_if(reference == c))
    return [
        F.count("*").alias("n"),
        ratio(n_if(covered), F.count("*")).alias("coverage"),
        ratio(n_if(right), F.count("*")).alias("accuracy"),
        ratio(n_if(right & covered), n_if(covered)).alias("covered_accuracy"),
        ((side(positive) + side(negative)) / 2).alias("balanced_accuracy"),
        n_if((reference == negative) & (prediction == positive)).alias("false_positives"),
        n_if((reference == positive) & (prediction == negative)).alias("false_negatives"),
        n_if(~covered).alias("refusals"),
    ]


def grouped_metrics(df: DataFrame, groups: list[str], metrics: list[Column]) -> DataFrame:
    """The metrics over all rows (null groups) and for each combination of groups, in one pass."""
    sets = [[F.col(g) for g in groups], []]
    return df.groupingSets(sets, *groups).agg(F.grouping_id().alias("__level"), *metrics).withColumn("scope", F.when(F.col("__level") == 0, "group").otherwise("all")).drop("__level")


def window_features(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, n, mean, median, std (population), rms."""
    v = F.col(value)
    return df.groupBy(*keys).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.median(v).alias("median"), F.stddev_pop(v).alias("std"), F.sqrt(F.avg(v * v)).alias("rms"))


def average_ranks(df: DataFrame, value: str, out: str, by: list[str] | None = None, parts: int = 64) -> DataFrame:
    """Ranks from 1, ties at their mean. Distinct values are ranked and joined back, so that the window holds one row a value.

    Without groups the values are cut at approximate quantiles into ``parts`` ranges, which are ranked side by side.
    """
    by = by or []
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("__n"))
    upto = lambda *keys: F.coalesce(F.sum("__n").over(W.partitionBy(*keys).orderBy(value).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    if by:
        below = upto(*by)
    else:
        cuts = counts.select(F.percentile_approx(value, [i / parts for i in range(1, parts)], 1000).alias("c")).first()["c"] or []
        cuts = sorted(set(cuts))
        counts = counts.withColumn("__part", sum(((F.col(value) > c).cast("int") for c in cuts), F.lit(0)))
        sizes = dict(counts.groupBy("__part").agg(F.sum("__n")).collect())  # at most ``parts`` rows
        before = {p: sum(n for q, n in sizes.items() if q < p) for p in sizes}
        start = F.create_map(*[F.lit(x) for p in before for x in (p, before[p])]) if before else None
        below = upto("__part") + (F.element_at(start, F.col("__part")) if before else F.lit(0))
    ranks = counts.withColumn(out, below + (F.col("__n") + 1) / 2).drop("__n", "__part")
    return df.join(ranks, [*by, value])


def spearman(df: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    """by, n, rho of rows that have both values; null where a side is constant."""
    both = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*by, x, y)
    ranked = average_ranks(average_ranks(both, x, "__rx", by), y, "__ry", by)
    varies = (F.stddev_pop("__rx") > 0) & (F.stddev_pop("__ry") > 0)
    rho = F.try_divide(F.covar_pop("__rx", "__ry"), F.stddev_pop("__rx") * F.stddev_pop("__ry"))
    return ranked.groupBy(*by).agg(F.count("*").alias("n"), F.when(varies, rho).alias("rho"))


def band_histogram(df: DataFrame, value: str, bad: str, bands: list[tuple[str, float, float]]) -> DataFrame:
    """band, n, bad_rate for closed bands, which may leave gaps; values in a gap are in no band."""
    of = F.lit(None).cast("string")
    for name, low, high in reversed(bands):
        of = F.when(F.col(value).between(low, high), name).otherwise(of)
    return df.withColumn("band", of).filter("band is not null").groupBy("band").agg(F.count("*").alias("n"), ratio(n_if(F.col(bad)), F.count("*")).alias("bad_rate"))


def relation_distribution(df: DataFrame, relation: str, confidence: str, cost: str) -> DataFrame:
    """relation, n, share, mean_confidence, cost, place (1 for the largest class, ties by name)."""
    classes = df.groupBy(F.col(relation).alias("relation")).agg(F.count("*").alias("n"), F.avg(confidence).alias("mean_confidence"), F.sum(cost).alias("cost"))
    every = W.partitionBy(F.lit(1))  # one row a class
    return classes.select("relation", "n", (F.col("n") / F.sum("n").over(every)).alias("share"), "mean_confidence", "cost", F.row_number().over(every.orderBy(F.desc("n"), "relation")).alias("place"))


def run_stability(df: DataFrame, key: str, right: str) -> DataFrame:
    """key, runs, stability: always_right, flaky or always_wrong."""
    kind = F.when(F.bool_and(right), "always_right").when(F.bool_or(right), "flaky").otherwise("always_wrong")
    return df.groupBy(key).agg(F.count("*").alias("runs"), kind.alias("stability"))


def collapse_rates(df: DataFrame, label: str, collapsed: str, same: list[str], different: list[str]) -> DataFrame:
    """n_same, under_collapsed, n_different, over_collapsed; the two errors are never added up."""
    a, b, c = F.col(label).isin(*same), F.col(label).isin(*different), F.col(collapsed)
    return df.agg(n_if(a).alias("n_same"), n_if(a & ~c).alias("under_collapsed"), n_if(b).alias("n_different"), n_if(b & c).alias("over_collapsed"))


def segment_counts(df: DataFrame, subset: str, activity: str) -> DataFrame:
    """subset, activity, n by both, by each, and overall (null: all)."""
    s, a = F.col(subset), F.col(activity)
    return df.groupingSets([[s, a], [s], [a], []], s, a).agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


def cardinality_violations(roles: DataFrame, bindings: DataFrame) -> DataFrame:
    """assertion_id, role_id, n, code. roles: assertion_id, role_id, min_count, max_count (null: no limit); an unfilled role counts 0."""
    n = bindings.groupBy("assertion_id", "role_id").agg(F.count("*").alias("n"))
    out = roles.join(n, ["assertion_id", "role_id"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    code = F.when(F.col("n") < F.col("min_count"), "TOO_FEW").when(F.col("n") > F.col("max_count"), "TOO_MANY")
    return out.select("assertion_id", "role_id", "n", code.alias("code")).filter("code is not null")


def channel_factors(obs: DataFrame, episode: str, channel: str, at: str, value: str, evidence: str, stable_below: float = 1.0, level: float = 1.0) -> DataFrame:
    """episode, channel, mean, spread, stable, first_value, last_value, changed, n, evidence.

    A channel is stable if its spread is below the bound; it has changed if just one of its first and last values is over ``level``.
    evidence: the sorted ids of its observations.
    """
    order = F.struct(at, value)
    spread, first, last = F.max(value) - F.min(value), F.min_by(value, order), F.max_by(value, order)
    return obs.groupBy(episode, channel).agg(
        F.avg(value).alias("mean"),
        spread.alias("spread"),
        (spread < stable_below).alias("stable"),
        first.alias("first_value"),
        last.alias("last_value"),
        ((first > level) != (last > level)).alias("changed"),
        F.count("*").alias("n"),
        F.array_sort(F.collect_list(evidence)).alias("evidence"),
    )


def identity_factors(obs: DataFrame, episode: str, at: str, signature: str, instance: str) -> DataFrame:
    """episode, max_gap between distinct times, one_signature, n_instances."""
    gap = max_gap(obs.select(episode, at).filter(F.col(at).isNotNull()), [episode], at)
    rest = obs.groupBy(episode).agg((F.count_distinct(signature) == 1).alias("one_signature"), F.count_distinct(instance).alias("n_instances"))
    return rest.join(gap, episode, "left")


def lineage_rollup(rows: DataFrame, key: str, status: str) -> DataFrame:
    """key, lineage (asserted, unknown or mixed), warnings."""
    kinds = F.collect_set(status)
    roll = F.when(F.array_contains(kinds, "asserted") & (F.size(kinds) == 1), "asserted").when(F.array_contains(kinds, "unknown") & (F.size(kinds) == 1), "unknown").otherwise("mixed")
    out = rows.groupBy(key).agg(roll.alias("lineage"), n_if(F.col(status) == "unknown").alias("n_unknown"), F.count("*").alias("n"))
    warnings = F.array_compact(F.array(F.when(F.col("n_unknown") > 0, F.lit("unknown_source")), F.when(F.col("lineage") == "mixed", F.lit("mixed_lineage"))))
    return out.select(key, "lineage", F.array_join(warnings, ",").alias("warnings"))


def probe_summary(df: DataFrame, keys: list[str], run: str, candidates: str, role: str, predicate: str) -> DataFrame:
    """keys, counts ("run:n" in order of runs), runs_with_role, predicates (sorted)."""
    counts = F.transform(F.array_sort(F.collect_list(F.struct(run, candidates))), lambda s: F.concat_ws(":", s[run].cast("string"), s[candidates].cast("string")))
    return df.groupBy(*keys).agg(F.array_join(counts, ",").alias("counts"), n_if(F.col(role).isNotNull()).alias("runs_with_role"), F.array_join(F.array_sort(F.collect_set(predicate)), ",").alias("predicates"))


def outcome_summary(df: DataFrame, outcome: str, outcomes: list[str], costs: list[str]) -> DataFrame:
    """n_<outcome> for each outcome, n_total, cost; null costs are 0."""
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in costs])
    return df.agg(*[n_if(F.col(outcome) == o).alias(f"n_{o}") for o in outcomes], F.count("*").alias("n_total"), F.coalesce(F.sum(total), F.lit(0.0)).alias("cost"))


def exact_quantiles(df: DataFrame, by: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """by and a column for each quantile, exact, with linear interpolation between neighbours; null values are left out.

    Distinct values are counted, dealt by ranges and numbered range by range, and the few rows at the wanted places are picked, so
    no task holds all values of a group, however large it is.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("__v")).agg(F.count("*").alias("__n"))
    dealt = written(counts.repartitionByRange(*by, "__v").withColumn("__p", F.spark_partition_id()), "ranges")
    upto = lambda keys, order: F.coalesce(F.sum("__n").over(W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    every = [*by, F.lit(0).alias("__one")]
    sizes = dealt.groupBy(*every, "__p").agg(F.sum("__n").alias("__n"))  # a row for each group and range
    starts = sizes.select(*by, "__one", "__p", upto([*by, "__one"], "__p").alias("__before"), F.sum("__n").over(W.partitionBy(*by, "__one")).alias("__total"))
    keys = [*by, "__p"]
    placed = dealt.withColumn("__below", upto(keys, "__v")).join(starts.drop("__one"), keys)
    low = F.col("__below") + F.col("__before")
    inside = lambda at: F.when((at >= low) & (at < low + F.col("__n")), F.col("__v"))
    picks = []
    for i, q in enumerate(quantiles.values()):
        place = (F.col("__total") - 1) * F.lit(float(q))
        picks += [F.max(inside(F.floor(place))).alias(f"__a{i}"), F.max(inside(F.ceil(place))).alias(f"__b{i}"), F.max(place - F.floor(place)).alias(f"__w{i}")]
    found = placed.groupBy(*by).agg(*picks)
    mixed = [(F.col(f"__a{i}") + (F.col(f"__b{i}") - F.col(f"__a{i}")) * F.col(f"__w{i}")).alias(name) for i, name in enumerate(quantiles)]
    return found.select(*by, *mixed)


def calibrate(df: DataFrame, label: str, value: str, quantiles: dict[str, tuple[str, float]]) -> DataFrame:
    """One row of thresholds: name -> exact quantile of the values of one class; null where the class has none."""
    wanted = sorted({c for c, _ in quantiles.values()})
    found = exact_quantiles(df.filter(F.col(label).isin(*wanted)).select(F.col(label).alias("__label"), F.col(value).alias("__value")), ["__label"], "__value", {n: q for n, (_, q) in quantiles.items()})
    return found.agg(*[F.max(F.when(F.col("__label") == c, F.col(n))).alias(n) for n, (c, _) in quantiles.items()])


def grid_search(df: DataFrame, value: str, reference: str, centers: list[float], half: float, positive: str, negative: str) -> DataFrame:
    """center and the refusal metrics at each center of a short grid; each row is spread over the grid and summed at once."""
    grid = df.select(value, reference, F.explode(F.array(*[F.lit(c) for c in centers])).alias("center"))
    out = grid.withColumn("__p", band(F.col(value), F.col("center"), F.lit(half), (positive, negative, "refused")))
    return out.groupBy("center").agg(*refusal_metrics(F.col(reference), F.col("__p"), positive, negative))


def best_of_grid(grid: DataFrame) -> DataFrame:
    """The row of largest balanced accuracy, then coverage, then smallest center."""
    return grid.filter("balanced_accuracy is not null").orderBy(F.desc("balanced_accuracy"), F.desc("coverage"), "center").limit(1)


def dropout(df: DataFrame, channels: list[str], keys: list[str]) -> DataFrame:
    """keys, dropped, total: the sum of all channels but one, for each channel in turn."""
    every = reduce(lambda a, b: a + b, [F.col(c) for c in channels])
    each = F.array(*[F.struct(F.lit(c).alias("dropped"), (every - F.col(c)).alias("total")) for c in channels])
    return df.select(*keys, F.inline(each))


def dropout_metrics(df: DataFrame, channels: list[str], groups: list[str], reference: str, predict, positive: str, negative: str) -> DataFrame:
    """dropped, groups, scope and the refusal metrics of each channel's absence, over all rows and for each combination of groups.

    ``predict``: Column of the sum without the channel -> prediction. Each row is spread over the channels and summed at once.
    """
    spread = dropout(df, channels, [*groups, reference]).withColumn("__p", predict(F.col("total")))
    metrics = refusal_metrics(F.col(reference), F.col("__p"), positive, negative)
    sets = [[F.col("dropped"), *[F.col(g) for g in groups]], [F.col("dropped")]]
    out = spread.groupingSets(sets, "dropped", *groups).agg(F.grouping_id().alias("__level"), *metrics)
    return out.withColumn("scope", F.when(F.col("__level") == 0, "group").otherwise("all")).drop("__level")


def perturbation_stability(df: DataFrame, feature: Column, perturbed: dict[str, Column], predict) -> DataFrame:
    """n, unchanged (share of same predictions) and max_drift over rows x perturbations."""
    each = F.array(*[F.struct(F.lit(n).alias("perturbation"), f.alias("f")) for n, f in perturbed.items()])
    rows = df.select(feature.alias("base"), F.inline(each))
    return rows.agg(F.count("*").alias("n"), F.avg((predict(F.col("base")) == predict(F.col("f"))).cast("int")).alias("unchanged"), F.max(F.abs(F.col("base") - F.col("f"))).alias("max_drift"))
