"""Compiling catalogs: predicates, roles, types, constraints, mappings, and additive versions of them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosslink.functions.ids import positional_role_id, predicate_id, role_id, type_id
from crosslink.operators.graph import ancestor_closure
from crosslink.operators.match import exclude_existing, induced_edges


def compile_catalog(predicates: DataFrame, slots: DataFrame, hierarchy: DataFrame) -> dict[str, DataFrame]:
    """Tables of a catalog from donor tables; of rows with the same id the first by ord stays.

    predicates: name, description, source, ord. slots: name, label, type (nullable), required (0/1), ord. hierarchy: child, parent.
    Slots with a blank label, or whose predicate isn't there, are in ``rejected_slots`` with their reason.
    """
    first = lambda df, key: df.groupBy(key).agg(F.min_by(F.struct(*[c for c in df.columns if c != key]), F.struct("ord", F.xxhash64(*[c for c in df.columns if c != key]))).alias("__r")).select(key, "__r.*")
    p = first(predicates.select(predicate_id(F.col("name")).alias("predicate_id"), F.col("name").alias("preferred_label"), "description", "source", "ord"), "predicate_id")
    keyed = slots.select(predicate_id(F.col("name")).alias("predicate_id"), "label", "type", "required", "ord")
    reason = F.when(F.coalesce(F.trim("label"), F.lit("")) == "", "blank_label").when(F.col("__there").isNull(), "unknown_predicate")
    keyed = keyed.join(p.select("predicate_id", F.lit(True).alias("__there")), "predicate_id", "left").withColumn("reason", reason)
    good = keyed.filter("reason is null").select("predicate_id", role_id(F.col("label")).alias("role_id"), F.trim("label").alias("runtime_name"), type_id(F.col("type")).alias("type_id"), F.col("type").alias("type_name"), (F.col("required") == 1).alias("required"), "ord")
    edges = good.groupBy("predicate_id", "role_id").agg(F.bool_or("required").alias("required"), F.min("ord").alias("ord"))
    types = good.filter("type_id is not null").select("type_id", F.col("type_name").alias("preferred_label")).groupBy("type_id").agg(F.min("preferred_label").alias("preferred_label"))
    closure = ancestor_closure(hierarchy)
    seeds = good.filter("type_name is not null").select(F.col("type_name").alias("node")).distinct()
    kept = seeds.select(F.col("node").alias("id")).unionByName(closure.join(seeds, "node", "left_semi").select(F.col("ancestor").alias("id"))).distinct()
    return {
        "predicate_types": p.select("predicate_id", "preferred_label", "description"),
        "role_types": good.groupBy("role_id").agg(F.min_by("runtime_name", F.struct("ord", "runtime_name")).alias("runtime_name")),
        "predicate_role_edges": edges.select("predicate_id", "role_id", "required", F.when(F.col("required"), 1).otherwise(0).alias("min_count"), F.lit(1).alias("max_count")),
        "entity_types": types,
        "constraints": good.filter("type_id is not null").select("predicate_id", "role_id", F.col("type_id").alias("expected_type")).distinct(),
        "source_mappings": p.select(F.col("predicate_id").alias("canonical_id"), F.lit("predicate").alias("canonical_kind"), F.col("source").alias("source_system"), F.col("preferred_label").alias("source_id")),
        "hierarchy_edges": induced_edges(hierarchy, kept),
        "rejected_slots": keyed.filter("reason is not null").select("predicate_id", "label", "reason"),
    }


def relation_dispositions(relations: DataFrame, modules: DataFrame) -> DataFrame:
    """``relations`` (relation, module, ...) with disposition: approved, reviewed_exclusion, unknown_module, or function (names that end in Fn)."""
    m = modules.select("module", F.col("disposition").alias("__d")).dropDuplicates(["module"])
    what = F.when(F.endswith("relation", F.lit("Fn")), "function").when(F.col("__d") == "approved", "approved").when(F.col("__d").isNotNull(), "reviewed_exclusion").otherwise("unknown_module")
    return relations.join(m, "module", "left").select(*relations.columns, what.alias("disposition"))


def compile_additive_slice(relations: DataFrame, constraints: DataFrame, modules: DataFrame, owned: dict[str, DataFrame], hierarchy: DataFrame | None = None, closure: DataFrame | None = None) -> dict[str, DataFrame]:
    """Predicates, positional roles 1..arity, constraints, types and hierarchy edges of approved relations that no ancestor owns.

    relations: relation, arity, module; constraints: relation, position, required_type, module; owned: ``predicates`` (predicate_id),
    ``roles`` (role_id), ``types`` (type_id), ``edges`` (child_id, parent_id). hierarchy: child, parent, by names of types; closure:
    node, ancestor of it, computed if it isn't given (``closure_delta`` keeps a stored one up to date). The types are the required
    ones and all above them; the edges are those of the hierarchy between two of these. ``counts`` has the rows of each disposition.
    """
    marked = relation_dispositions(relations, modules)
    new = marked.filter("disposition = 'approved'").select(predicate_id(F.col("relation")).alias("predicate_id"), "relation", "arity").dropDuplicates(["predicate_id"])
    new = exclude_existing(new, owned["predicates"], ["predicate_id"])
    edges = new.filter("arity > 0").select("predicate_id", "relation", F.explode(F.sequence(F.lit(1), F.col("arity").cast("int"))).alias("position"))
    roles = exclude_existing(edges.select(positional_role_id(F.col("position")).alias("role_id")).distinct(), owned["roles"], ["role_id"])
    good = relation_dispositions(constraints, modules).filter("disposition = 'approved'").join(edges, ["relation", "position"])
    limits = good.select("predicate_id", positional_role_id(F.col("position")).alias("role_id"), type_id(F.col("required_type")).alias("expected_type")).distinct()
    tables = {"predicate_types": new.select("predicate_id", "arity"), "predicate_role_edges": edges.select("predicate_id", positional_role_id(F.col("position")).alias("role_id")), "role_types": roles, "constraints": limits, "counts": marked.groupBy("disposition").count()}
    names = good.select(F.col("required_type").alias("id")).filter("id is not null").distinct()
    if hierarchy is not None:
        closure = ancestor_closure(hierarchy) if closure is None else closure
        above = closure.join(names, closure["node"] == names["id"], "left_semi").select(F.col("ancestor").alias("id"))
        names = names.unionByName(above).distinct()
        both = induced_edges(hierarchy, names).select(F.lit("subtype_of").alias("edge_type"), type_id(F.col("child")).alias("child_id"), type_id(F.col("parent")).alias("parent_id")).distinct()
        both = exclude_existing(both, owned["edges"], ["child_id", "parent_id"]) if "edges" in owned else both
        tables["hierarchy_edges"] = both.select("edge_type", "child_id", "parent_id")
    types = names.select(type_id(F.col("id")).alias("type_id"), F.regexp_replace("id", "^sumo:", "").alias("preferred_label")).groupBy("type_id").agg(F.min("preferred_label").alias("preferred_label"))
    return tables | {"entity_types": exclude_existing(types, owned["types"], ["type_id"])}


#: On what each kind of mapping rests.
BASES = {
    "predicate": "canonical predicate is compiled directly from the donor predicate row",
    "sense": "donor predicate row stores the exact PropBank sense identifier",
    "frame": "donor predicate row contains frame_id plus row mapping metadata; upstream verification and the mapping-method semantic scope are absent",
    "slot": "canonical role slot is compiled directly from the donor role row",
    "sense_slot": "donor role row source={}; named label remains donor-derived",
    "type": "donor role type_constraint and locally owned SUMO hierarchy",
}


def emit_provenance(predicates: DataFrame, slots: DataFrame) -> DataFrame:
    """canonical_id, canonical_kind, source_key, source_id, relation, derivation_method, confidence_basis, method_ref, method_scope, confidence, evidence_ref: all mappings of all predicates at once.

    predicates: name, sense_id, frame_id, mapping_source, mapping_confidence (all but name may be null); slots: name, label, arg, type
    (nullable), source. The donor gives each predicate and each of its roles; a sense gives them again by its own id; a frame is a
    candidate only, with the method of its row, whose meaning isn't known. A type is given once for each predicate, on the evidence
    of its first role; roles come in order of ``arg`` as text, as the donor's own query sorts them (ARG10 before ARG2).
    """
    p = predicates.withColumn("__id", F.concat(F.lit("lc:"), "name"))
    s = slots.withColumn("__id", F.concat(F.lit("lc:"), "name"))
    sensed = s.join(p.select("__id", "sense_id").dropDuplicates(["__id"]), "__id")
    role = F.concat_ws(":", "__id", role_id(F.col("label")))
    row = lambda field: F.concat(F.lit("predicates[name="), "name", F.lit(f"]{field}"))
    slot = lambda field: F.concat(F.lit("role_slots[name="), "name", F.lit(",arg="), "arg", F.lit(f"]{field}"))
    none = F.lit(None).cast("string")

    def rows(df, canonical, kind, source, source_id, relation, method, basis, evidence, ref=none, scope=none, confidence=None):
        columns = {"canonical_id": canonical, "canonical_kind": F.lit(kind), "source_key": F.lit(source), "source_id": source_id, "relation": F.lit(relation), "derivation_method": F.lit(method), "confidence_basis": basis}
        columns |= {"method_ref": ref, "method_scope": scope, "confidence": F.lit(None).cast("double") if confidence is None else confidence, "evidence_ref": evidence}
        return df.select(*[c.alias(n) for n, c in columns.items()]).filter("source_id is not null")

    types = s.filter("type is not null").withColumn("__type", type_id(F.col("type"))).groupBy("__id", "name", "__type").agg(F.min(F.struct("arg", "type")).alias("__first")).select("__id", "name", "__type", "__first.*")
    basis = lambda kind: F.lit(BASES[kind])
    row_basis = F.replace(basis("sense_slot"), F.lit("{}"), F.coalesce("source", F.lit("")))
    scope = F.when(F.col("mapping_source").isNotNull(), "unknown")
    parts = [
        rows(p, F.col("__id"), "predicate_type", "donor", F.col("name"), "derived_from", "direct_identifier", basis("predicate"), row(".name")),
        rows(p, F.col("__id"), "predicate_type", "propbank", F.col("sense_id"), "derived_from", "direct_identifier", basis("sense"), row(".sense_id")),
        rows(p, F.col("__id"), "predicate_type", "framenet_candidate", F.col("frame_id"), "candidate_alignment", "donor_asserted", basis("frame"), row("{frame_id,mapping_confidence,mapping_source}"), F.col("mapping_source"), scope, F.col("mapping_confidence")),
        rows(s, role, "role_slot", "donor", F.concat_ws(":", "name", "arg"), "positional_role", "direct_identifier", basis("slot"), slot("")),
        rows(sensed, role, "role_slot", "propbank", F.concat("sense_id", F.lit(":"), "arg"), "positional_role", "donor_asserted", row_basis, slot("")),
        rows(types, F.col("__type"), "entity_type", "sumo_types", F.col("type"), "typed_by", "donor_asserted", basis("type"), slot(".type_constraint")),
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def hierarchy_provenance(edges: DataFrame) -> DataFrame:
    """Provenance rows, as those of ``emit_provenance``, for hierarchy edges (child_id, parent_id)."""
    name = lambda c: F.regexp_replace(c, r"^lc:sumo_type\.", "")
    none = F.lit(None).cast("string")
    columns = {"canonical_id": F.concat_ws(":", "child_id", F.lit("subtype_of"), "parent_id"), "canonical_kind": F.lit("hierarchy_edge"), "source_key": F.lit("sumo_types")}
    columns |= {"source_id": F.concat_ws(":", name("child_id"), F.lit("subclass_of"), name("parent_id")), "relation": F.lit("subtype_of"), "derivation_method": F.lit("donor_asserted")}
    columns |= {"confidence_basis": F.lit("donor type_hierarchy row exported into the pack closure"), "method_ref": none, "method_scope": none, "confidence": F.lit(None).cast("double")}
    return edges.select(*[c.alias(n) for n, c in columns.items()], F.concat(F.lit("type_hierarchy[child="), name("child_id"), F.lit(",parent="), name("parent_id"), F.lit("]")).alias("evidence_ref"))
