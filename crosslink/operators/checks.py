"""Data-quality gates: each returns a table of violations, empty if all is well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def field_violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """key, code: one row for each rule that a row breaks. A rule is a condition that says the row is bad; null says it isn't."""
    codes = F.array_compact(F.array(*[F.when(bad, F.lit(code)) for code, bad in rules.items()]))
    return df.select(key, F.explode(codes).alias("code"))


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def blank_if_given(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) == "")


def no_confidence(c: Column) -> Column:
    """Given, but not a finite number from 0 to 1."""
    return c.isNotNull() & (F.isnan(c) | (c < 0) | (c > 1))


def no_flag(c: Column) -> Column:
    return c.isNull() | ~c.isin(0, 1)


def illegal_combinations(df: DataFrame, allowed: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose combination of columns isn't in the table of allowed ones."""
    return df.join(allowed.select(*columns).distinct(), columns, "left_anti")


#: Which relations each kind of record may have, and which kinds and relations each source may give.
KIND_RELATIONS = {"predicate_type": ["derived_from", "candidate_alignment"], "role_slot": ["positional_role"], "entity_type": ["typed_by"], "hierarchy_edge": ["subtype_of"]}
SOURCE_RELATIONS = {
    "donor": {"predicate_type": ["derived_from"], "role_slot": ["positional_role"]},
    "propbank": {"predicate_type": ["derived_from"], "role_slot": ["positional_role"]},
    "framenet_candidate": {"predicate_type": ["candidate_alignment"]},
    "sumo_types": {"entity_type": ["typed_by"], "hierarchy_edge": ["subtype_of"]},
}


def mapping_violations(records: DataFrame, key: str) -> DataFrame:
    """key, code: the first rule that a mapping record breaks.

    records: canonical_kind, relation, source_key, method_ref, method_scope, confidence. The kind must allow the relation; a method
    reference and its scope come together; these and a confidence belong to candidate alignments only; the source must be known and
    may give this kind by this relation only.
    """
    kind, relation, source = F.col("canonical_kind"), F.col("relation"), F.col("source_key")
    pairs = [f"{k}|{r}" for k, rs in KIND_RELATIONS.items() for r in rs]
    triples = [f"{s}|{k}|{r}" for s, kinds in SOURCE_RELATIONS.items() for k, rs in kinds.items() for r in rs]
    candidate = relation == "candidate_alignment"
    codes = {
        "RELATION_OF_KIND": ~F.coalesce(F.concat_ws("|", kind, relation).isin(*pairs), F.lit(False)),
        "METHOD_WITHOUT_SCOPE": F.col("method_ref").isNull() != F.col("method_scope").isNull(),
        "METHOD_OF_NO_CANDIDATE": F.col("method_ref").isNotNull() & ~candidate,
        "CONFIDENCE_OF_NO_CANDIDATE": F.col("confidence").isNotNull() & ~candidate,
        "UNKNOWN_SOURCE": ~F.coalesce(source.isin(*SOURCE_RELATIONS), F.lit(False)),
        "RELATION_OF_SOURCE": ~F.coalesce(F.concat_ws("|", source, kind, relation).isin(*triples), F.lit(False)),
    }
    code = F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in codes.items()])
    return records.select(key, code.alias("code")).filter("code is not null")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n of keys that more than one row has."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def dependency_violations(df: DataFrame, a: str, b: str) -> DataFrame:
    """side, value, n: values of ``a`` with several ``b`` and the reverse; a and b should be one to one."""
    side = lambda x, y: df.groupBy(F.col(x).cast("string").alias("value")).agg(F.count_distinct(y).alias("n")).filter("n > 1").select(F.lit(f"{x}->{y}").alias("side"), "value", "n")
    return side(a, b).unionByName(side(b, a))


def identity_conflicts(df: DataFrame, key: str, path: str) -> DataFrame:
    """key, paths: ids that are declared in more than one path."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set(path)).alias("paths")).filter(F.size("paths") > 1)


def dangling(refs: dict[str, tuple[DataFrame, str]], nodes: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """kind, ref: ids of each kind that are referred to but not declared."""
    parts = []
    for kind, (df, c) in refs.items():
        ids, name = nodes[kind]
        ref = df.select(F.lit(kind).alias("kind"), F.col(c).cast("string").alias("ref")).filter("ref is not null").distinct()
        parts.append(ref.join(ids.select(F.col(name).cast("string").alias("ref")).distinct(), "ref", "left_anti").select("kind", "ref"))
    return reduce(DataFrame.unionByName, parts)


def reconcile(totals: DataFrame, equations: dict[str, tuple[Column, Column]]) -> DataFrame:
    """check, lhs, rhs, ok for each equation over a table of one row."""
    rows = F.array(*[F.struct(F.lit(n).alias("check"), a.cast("long").alias("lhs"), b.cast("long").alias("rhs"), a.cast("long").eqNullSafe(b.cast("long")).alias("ok")) for n, (a, b) in equations.items()])
    return totals.select(F.inline(rows))


def multiset_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_left, n_right where two tables differ as bags of keys."""
    n = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias(name))
    same = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    both = n(a, "n_left").alias("a").join(n(b, "n_right").alias("b"), same, "full_outer")
    out = both.select(*[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys], F.coalesce("n_left", F.lit(0)).alias("n_left"), F.coalesce("n_right", F.lit(0)).alias("n_right"))
    return out.filter("n_left <> n_right")


def non_empty(df: DataFrame, what: str) -> DataFrame:
    """``df``; raises if it has no rows."""
    if df.isEmpty():
        raise ValueError(f"{what}: no rows, so there is nothing to check")
    return df


def mirror_violations(outgoing: DataFrame, incoming: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """keys, status: relations without an equal one on the other side with ``a`` and ``b`` swapped."""
    left = outgoing.select(*keys, F.col(a).alias("oa"), F.col(b).alias("ob")).alias("l")
    right = incoming.select(*keys, F.col(b).alias("ia"), F.col(a).alias("ib")).alias("r")
    both = left.join(right, keys, "full_outer")
    same = F.col("oa").eqNullSafe(F.col("ia")) & F.col("ob").eqNullSafe(F.col("ib"))
    status = F.when(F.col("ia").isNull() & F.col("ib").isNull(), "no_incoming").when(F.col("oa").isNull() & F.col("ob").isNull(), "no_outgoing").when(~same, "not_swapped")
    return both.select(*keys, status.alias("status")).filter("status is not null")


def not_additive(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of the old version that the new one lacks, as a bag."""
    return old.exceptAll(new.select(*old.columns))


def projection_rule_violations(rules: DataFrame) -> DataFrame:
    """projection_id, code. rules: projection_id, roles, selected, omitted, endpoints (arrays), target_view, loss."""
    both = F.array_union("selected", "omitted")
    return field_violations(
        rules,
        "projection_id",
        {
            "ROLES_NOT_COVERED": (F.size(F.array_except("roles", both)) > 0) | (F.size(F.array_except(both, F.col("roles"))) > 0),
            "SELECTED_AND_OMITTED": F.arrays_overlap("selected", "omitted"),
            "EDGE_NEEDS_TWO_ENDPOINTS": (F.col("target_view") == "edge") & ((F.size("endpoints") != 2) | (F.size(F.array_distinct("endpoints")) != 2)),
            "ENDPOINT_NOT_SELECTED": F.size(F.array_except("endpoints", F.col("selected"))) > 0,
            "LOSSLESS_WITH_OMISSION": (F.size("omitted") > 0) & (F.col("loss") == "lossless"),
        },
    )


def overlapping_groups(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Groups that are in both parts of a split."""
    return a.select(key).intersect(b.select(key))


def population_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key, side: keys that only one of two sets has."""
    only = lambda x, y, side: x.select(key).distinct().join(y.select(key).distinct(), key, "left_anti").withColumn("side", F.lit(side))
    return only(a, b, "left").unionByName(only(b, a, "right"))


def replay_difference(stored: DataFrame, again: DataFrame) -> DataFrame:
    """Rows that a stored derived table and its recomputation don't share, with side."""
    cols = stored.columns
    return stored.exceptAll(again.select(*cols)).withColumn("side", F.lit("stored")).unionByName(again.select(*cols).exceptAll(stored).withColumn("side", F.lit("recomputed")))


def catalog_violations(tables: dict[str, DataFrame], keys: dict[str, list[str]], refs: list[tuple[str, str, str, str]]) -> DataFrame:
    """asset, code, detail: repeated keys and dangling references over a set of tables. refs: (table, column, target table, its id)."""
    parts = []
    for name, key in keys.items():
        parts.append(duplicate_keys(tables[name], key).select(F.lit(name).alias("asset"), F.lit("DUPLICATE_KEY").alias("code"), F.concat_ws("|", *key).alias("detail")))
    for name, c, target, to in refs:
        missing = dangling({target: (tables[name], c)}, {target: (tables[target], to)})
        parts.append(missing.select(F.lit(name).alias("asset"), F.lit(f"DANGLING_{c}".upper()).alias("code"), F.col("ref").alias("detail")))
    return reduce(DataFrame.unionByName, parts)


#: The source keys whose rows must cover a pack, and what a pack's ids of each kind are made of.
DIRECT, SENSES, TYPES = "donor", "propbank", "sumo_types"


def pack_violations(tables: dict[str, DataFrame], sources: list[str], expected: dict[str, int] | None = None) -> DataFrame:
    """asset, code, detail: where the provenance of a pack does not match its tables.

    tables: predicate_types (predicate_id), predicate_role_edges (predicate_id, role_id), entity_types (type_id), hierarchy_edges
    (child_id, parent_id), constraints (predicate_id, expected_type), source_mappings (canonical_id, canonical_kind, source_system,
    source_id, mapping_type), semantic_mappings (canonical_id, canonical_kind, source_key, source_id, relation). Codes:
    UNDECLARED_SOURCE; DANGLING_<KIND>; PREDICATE_NOT_COVERED and HIERARCHY_NOT_COVERED, where the ids of both sides are not the same
    set; ROLE_BAG, TYPE_BAG and SENSE_BAG, where they are not the same bag; COUNT, where a source of ``expected`` has not so many
    mappings of predicates, each of another one.
    """
    rows, declared = tables["semantic_mappings"], F.col("source_key").isin(*sources)
    edge_id, slot_id = F.concat_ws(":", "child_id", F.lit("subtype_of"), "parent_id"), F.concat_ws(":", "predicate_id", "role_id")
    ids = {
        "predicate_type": tables["predicate_types"].select(F.col("predicate_id").alias("detail")),
        "role_slot": tables["predicate_role_edges"].select(slot_id.alias("detail")),
        "entity_type": tables["entity_types"].select(F.col("type_id").alias("detail")),
        "hierarchy_edge": tables["hierarchy_edges"].select(edge_id.alias("detail")),
    }
    of = lambda kind, *keys: rows.filter((F.col("canonical_kind") == kind) & (F.col("source_key").isin(*keys) if keys else F.lit(True))).select(F.col("canonical_id").alias("detail"))
    said = lambda df, code: df.select(F.lit("semantic_mappings").alias("asset"), F.lit(code).alias("code"), F.col("detail").cast("string").alias("detail"))
    parts = [said(rows.filter(~F.coalesce(declared, F.lit(False))).select(F.coalesce("source_key", F.lit("")).alias("detail")).distinct(), "UNDECLARED_SOURCE")]
    parts += [said(of(kind).distinct().join(every.distinct(), "detail", "left_anti"), f"DANGLING_{kind}".upper()) for kind, every in ids.items()]
    parts.append(said(population_difference(of("predicate_type", DIRECT), ids["predicate_type"], "detail"), "PREDICATE_NOT_COVERED"))
    parts.append(said(population_difference(of("hierarchy_edge"), ids["hierarchy_edge"], "detail"), "HIERARCHY_NOT_COVERED"))
    parts.append(said(multiset_difference(of("role_slot", DIRECT), ids["role_slot"], ["detail"]), "ROLE_BAG"))
    wanted = tables["constraints"].select("predicate_id", "expected_type").distinct().filter("expected_type is not null").select(F.col("expected_type").alias("detail"))
    parts.append(said(multiset_difference(of("entity_type", TYPES), wanted, ["detail"]), "TYPE_BAG"))
    bag = lambda df, system, *columns: df.filter(F.col(system) == SENSES).select(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in columns]).alias("detail"))
    parts.append(said(multiset_difference(bag(rows, "source_key", "canonical_id", "canonical_kind", "source_id", "relation"), bag(tables["source_mappings"], "source_system", "canonical_id", "canonical_kind", "source_id", "mapping_type"), ["detail"]), "SENSE_BAG"))
    for key, n in (expected or {}).items():
        counts = of("predicate_type", key).agg(F.count("*").alias("n"), F.count_distinct("detail").alias("ids")).filter((F.col("n") != n) | (F.col("ids") != n))
        parts.append(said(counts.select(F.concat_ws(" ", F.lit(key), "n", "ids").alias("detail")), "COUNT"))
    return reduce(DataFrame.unionByName, parts)


def projection_closure(families: dict[str, tuple[DataFrame, list[str]]], terms: DataFrame, modules: DataFrame) -> DataFrame:
    """asset, code, detail: axioms that name a term without an inventory row, come from a module that isn't listed, or repeat a (path, idx).

    families: table with path and idx, and its term columns; terms: term; modules: path.
    """
    parts = []
    for name, (df, columns) in families.items():
        refs = reduce(DataFrame.unionByName, [df.select(F.col(c).cast("string").alias("detail")) for c in columns]).filter("detail is not null").distinct()
        parts.append(refs.join(terms.select(F.col("term").cast("string").alias("detail")).distinct(), "detail", "left_anti").select(F.lit(name).alias("asset"), F.lit("UNKNOWN_TERM").alias("code"), "detail"))
        paths = df.select(F.col("path").cast("string").alias("detail")).distinct()
        parts.append(paths.join(modules.select(F.col("path").cast("string").alias("detail")).distinct(), "detail", "left_anti").select(F.lit(name).alias("asset"), F.lit("UNKNOWN_MODULE").alias("code"), "detail"))
        parts.append(duplicate_keys(df, ["path", "idx"]).select(F.lit(name).alias("asset"), F.lit("DUPLICATE_AXIOM").alias("code"), F.concat_ws("#", "path", "idx").alias("detail")))
    return reduce(DataFrame.unionByName, parts)


def common_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that both runs have."""
    return a.select(*keys).intersect(b.select(*keys))
