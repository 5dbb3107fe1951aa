"""Rule cascades: reviews, mapping requests, assertions, projections, pair decisions. The first rule that fails gives the reason."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crosslink.functions.values import exact_mean, interchanged, participants_match


def cascade(checks: dict[str, Column], otherwise: str = "ALLOWED") -> Column:
    """The code of the first check that holds; a null check doesn't."""
    return F.coalesce(*[F.when(c, F.lit(code)) for code, c in checks.items()], F.lit(otherwise))


def two_pass(a: Column, b: Column) -> Column:
    """Both support: tentatively_verified; both contradict: rejected; else unresolved."""
    return F.when((a == "supports") & (b == "supports"), "tentatively_verified").when((a == "contradicts") & (b == "contradicts"), "rejected").otherwise("unresolved")


def review_queue(roles: DataFrame, status: str, wanted: str, prefix: str, evidence: DataFrame) -> DataFrame:
    """case_id, predicate_id, label, evidence (map of field to text) of the roles with one status. evidence: predicate_id, field, text."""
    e = evidence.filter("text is not null").groupBy("predicate_id").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("field", "text")))).alias("evidence"))
    case = F.concat_ws(":", F.lit(prefix), "predicate_id", "label")
    return roles.filter(F.col(status) == wanted).select(case.alias("case_id"), "predicate_id", "label").join(e, "predicate_id", "left")


def governed_states(queue: DataFrame, proposals: DataFrame, decisions: DataFrame) -> DataFrame:
    """case_id, state, basis. proposals: case_id, disposition, quote_status; decisions: case_id, decision.

    Withheld evidence stays unresolved; a proposal whose quote isn't grounded can't decide; then the reviewed decision holds.
    """
    out = queue.select("case_id").join(proposals.select("case_id", "disposition", "quote_status").dropDuplicates(["case_id"]), "case_id", "left").join(decisions.select("case_id", "decision").dropDuplicates(["case_id"]), "case_id", "left")
    basis = cascade({"no_proposal": F.col("disposition").isNull(), "source_evidence_unavailable": F.col("disposition") == "withheld", "quote_not_grounded": F.col("quote_status") != "grounded", "not_reviewed": F.col("decision").isNull()}, "reviewed")
    state = F.when(basis == "reviewed", F.col("decision")).otherwise("unresolved")
    return out.select("case_id", state.alias("state"), basis.alias("basis"))


def append_reviews(crosswalk: DataFrame, reviews: DataFrame) -> DataFrame:
    """The crosswalk and a record for each review of one of its rows, which stays as it is; a record that is there already isn't repeated."""
    reviewed = reviews.join(crosswalk.select("record_id", *[c for c in crosswalk.columns if c not in ("record_id", "state", "reviews_record_id")]).dropDuplicates(["record_id"]), "record_id")
    key = F.concat(F.lit("lcr1_"), F.substring(F.sha2(F.concat_ws("\0", "record_id", "outcome"), 256), 1, 24))
    rows = reviewed.withColumn("reviews_record_id", F.col("record_id")).withColumn("record_id", key).withColumn("state", F.col("outcome"))
    base = crosswalk if "reviews_record_id" in crosswalk.columns else crosswalk.withColumn("reviews_record_id", F.lit(None).cast("string"))
    return base.unionByName(rows.select(*base.columns).dropDuplicates(["record_id"]).join(base.select("record_id"), "record_id", "left_anti"))


#: What a mapping over each relation needs, and the fields that each identity level compares.
LOSSY_RELATION, LOSSY_CONDITION = "narrowerThan", "commercial_transaction"
REVIEWED_RELATION, REVIEWED_CONDITION = "closeMatch", "contextual_equivalence_reviewed"
EMBEDDED_CONDITION = "compare_embedded_proposition"
IDENTITY_FIELDS = {
    "proposition": ["proposition_id"],
    "occurrence": ["proposition_id", "occurrence_id"],
    "assertion": ["proposition_id", "occurrence_id", "assertion_id"],
    "support": ["proposition_id", "occurrence_id", "assertion_id", "support_record_id"],
}


def evaluate_mappings(cases: DataFrame, predicates: DataFrame, roles: DataFrame, relations: DataFrame, correspondences: DataFrame) -> DataFrame:
    """case_id, status, reason of each mapping request; the first failing check is the reason, of an allowed one it is the relation.

    cases: case_id, from_id, to_id, from_roles, to_roles (maps role -> filler), transforms (array of struct from_role, to_role),
    from_scope, to_scope, loss, conditions (array), identity_level, from_identity, to_identity (structs with the fields of
    ``IDENTITY_FIELDS``). predicates: id. roles: predicate_id, role. relations: from_id, to_id, relation, ord; correspondences:
    from_id, from_role, to_id, to_role, via_relation, ord; the first by ord holds.

    Equal predicates are an identity, which must be lossless and needs no correspondence. A relation in the other direction only is
    refused, whatever it is. Roles that are transformed must be just the roles of either side.
    """
    ids = lambda c: predicates.select(F.col("id").alias(c), F.lit(True).alias(f"__{c}")).distinct()
    declared = lambda c, out: roles.groupBy(F.col("predicate_id").alias(c)).agg(F.collect_set("role").alias(out))
    first = relations.groupBy("from_id", "to_id").agg(F.min_by("relation", F.struct("ord", "relation")).alias("declared"))
    back = first.select(F.col("from_id").alias("to_id"), F.col("to_id").alias("from_id"), F.col("declared").alias("back"))
    four = ["from_id", "from_role", "to_id", "to_role"]
    one = correspondences.groupBy(*four).agg(F.min_by("via_relation", F.struct("ord", "via_relation")).alias("declared"))
    known = one.groupBy("from_id", "to_id", "declared").agg(F.collect_set(F.struct("from_role", "to_role")).alias("known"))
    df = cases
    for c in ("from_id", "to_id"):
        df = df.join(ids(c), c, "left").join(declared(c, c.replace("_id", "_declared")), c, "left")
    df = df.join(first, ["from_id", "to_id"], "left").join(back, ["from_id", "to_id"], "left").join(known, ["from_id", "to_id", "declared"], "left")
    same = F.col("from_id") == F.col("to_id")
    relation = F.when(same, "identity").otherwise(F.col("declared"))
    empty = F.array().cast("array<string>")
    undeclared = lambda side: F.size(F.array_except(F.map_keys(f"{side}_roles"), F.coalesce(f"{side}_declared", empty))) > 0
    moved = lambda side: F.transform("transforms", lambda t: t[f"{side}_role"])
    differs = lambda side: F.array_sort(F.array_distinct(moved(side))) != F.array_sort(F.map_keys(f"{side}_roles"))
    lacks = lambda condition: ~F.array_contains("conditions", condition)

    def unsupported(t: Column) -> Column:
        pair = F.struct(t["from_role"].alias("from_role"), t["to_role"].alias("to_role"))
        return ~same & ~F.coalesce(F.array_contains("known", pair), F.lit(False))

    def transform_fault(t: Column) -> Column:
        filled = F.try_element_at("from_roles", t["from_role"]).eqNullSafe(F.try_element_at("to_roles", t["to_role"]))
        return F.when(unsupported(t), "ROLE_TRANSFORM_UNSUPPORTED").when(~filled, "ROLE_FILLER_MISMATCH")

    fault = F.get(F.array_compact(F.transform("transforms", transform_fault)), F.lit(0))
    embedded = (F.col("identity_level") == "proposition") & ~lacks(EMBEDDED_CONDITION)
    unequal = lambda field: ~F.col(f"from_identity.{field}").eqNullSafe(F.col(f"to_identity.{field}"))
    identity = [(F.col("identity_level") == level) & reduce(Column.__or__, map(unequal, fields)) for level, fields in IDENTITY_FIELDS.items()]
    checks = [
        ("UNKNOWN_PREDICATE", F.col("__from_id").isNull()),
        ("UNDECLARED_PREDICATE_ROLE", undeclared("from")),
        ("UNKNOWN_PREDICATE", F.col("__to_id").isNull()),
        ("UNDECLARED_PREDICATE_ROLE", undeclared("to")),
        ("MAPPING_DIRECTION_UNSUPPORTED", relation.isNull() & F.col("back").isNotNull()),
        ("PREDICATE_MAPPING_UNSUPPORTED", relation.isNull()),
        ("NARROWER_PROJECTION_REQUIRES_LOSSY_CONTRACT", (relation == LOSSY_RELATION) & (F.col("loss") != "lossy")),
        ("MAPPING_CONDITION_MISSING", (relation == LOSSY_RELATION) & lacks(LOSSY_CONDITION)),
        ("CLOSE_MATCH_REQUIRES_CONTEXTUAL_REVIEW", (relation == REVIEWED_RELATION) & lacks(REVIEWED_CONDITION)),
        ("IDENTITY_MAPPING_MUST_BE_LOSSLESS", same & (F.col("loss") != "lossless")),
        ("RELATION_NOT_EXECUTABLE", ~relation.isin("identity", LOSSY_RELATION, REVIEWED_RELATION)),
        ("DUPLICATE_SOURCE_ROLE_TRANSFORM", F.size(F.array_distinct(moved("from"))) < F.size("transforms")),
        ("ROLE_TRANSFORM_SOURCE_COVERAGE_MISMATCH", differs("from")),
        ("ROLE_TRANSFORM_TARGET_COVERAGE_MISMATCH", differs("to")),
    ]
    codes = [F.when(bad, F.lit(code)) for code, bad in checks] + [fault]
    codes += [F.when(~F.col("from_scope").eqNullSafe(F.col("to_scope")) & ~embedded, "SCOPE_MISMATCH"), F.when(reduce(Column.__or__, identity), "IDENTITY_MISMATCH")]
    out = df.select("case_id", F.coalesce(*codes).alias("code"), relation.alias("relation"))
    return out.select("case_id", F.when(F.col("code").isNull(), "allowed").otherwise("rejected").alias("status"), F.coalesce("code", "relation").alias("reason"))


def score_cases(observed: DataFrame, expected: DataFrame) -> DataFrame:
    """case_id, passed: status equal and, where a reason is expected, reason equal or starting with it. expected: case_id, expected_status, expected_reason."""
    out = expected.join(observed, "case_id", "left")
    reason = F.col("expected_reason").isNull() | F.startswith(F.coalesce("reason", F.lit("")), F.col("expected_reason"))
    return out.select("case_id", (F.col("status").eqNullSafe(F.col("expected_status")) & reason).alias("passed"))


def nested_filler_violations(assertions: DataFrame, bindings: DataFrame, roles: DataFrame) -> DataFrame:
    """assertion_id, role_id, filler_id, code. An assertion may fill a role that expects no schema. assertions: assertion_id, schema_id; bindings: assertion_id, role_id, filler_kind, filler_id; roles: schema_id, role_id, filler_schema (null: a plain filler)."""
    a = assertions.select("assertion_id", "schema_id")
    out = bindings.join(a, "assertion_id", "left").join(roles.select("schema_id", "role_id", "filler_schema", F.lit(True).alias("__role")), ["schema_id", "role_id"], "left")
    out = out.join(a.select(F.col("assertion_id").alias("filler_id"), F.col("schema_id").alias("__filler_schema")), "filler_id", "left")
    nested = F.col("filler_kind") == "assertion"
    code = cascade(
        {
            "UNKNOWN_ASSERTION": F.col("schema_id").isNull(),
            "UNDECLARED_ROLE": F.col("__role").isNull(),
            "SELF_REFERENCE": nested & (F.col("filler_id") == F.col("assertion_id")),
            "MISSING_ASSERTION": nested & F.col("__filler_schema").isNull(),
            "ASSERTION_EXPECTED": ~nested & F.col("filler_schema").isNotNull(),
            "WRONG_SCHEMA": nested & F.col("filler_schema").isNotNull() & (F.col("__filler_schema") != F.col("filler_schema")),
        },
        "",
    )
    return out.select("assertion_id", "role_id", "filler_id", code.alias("code")).filter("code <> ''")


def validate_assertions(assertions: DataFrame, bindings: DataFrame, roles: DataFrame) -> DataFrame:
    """assertion_id, role_id, code: nested fillers and cardinalities together. roles also has min_count and max_count."""
    from crosslink.operators.metrics import cardinality_violations

    wanted = assertions.join(roles, "schema_id").select("assertion_id", "role_id", "min_count", "max_count")
    return nested_filler_violations(assertions, bindings, roles).select("assertion_id", "role_id", "code").unionByName(cardinality_violations(wanted, bindings).select("assertion_id", "role_id", "code"))


def project_assertions(bindings: DataFrame, rules: DataFrame) -> DataFrame:
    """assertion_id, projection_id, kept, endpoints, lost, loss, status. bindings: assertion_id, schema_id, role_id, filler_id; rules: projection_id, schema_id, selected, endpoints, omitted, loss.

    kept and lost are sorted "role=filler" lists; each endpoint needs exactly one filler; filled omitted roles are the receipt of
    what is lost, and a lossless rule may lose nothing.
    """
    rows = bindings.join(rules.withColumnRenamed("endpoints", "__ends"), "schema_id")
    item = F.concat_ws("=", "role_id", "filler_id")
    pick = lambda c: F.array_sort(F.collect_list(F.when(F.array_contains(c, F.col("role_id")), item)))
    ends = F.array_sort(F.collect_list(F.when(F.array_contains("__ends", F.col("role_id")), F.col("role_id"))))
    out = rows.groupBy("assertion_id", "projection_id", "loss", "__ends").agg(pick("selected").alias("kept"), pick("__ends").alias("endpoints"), pick("omitted").alias("lost"), ends.alias("__filled"))
    status = cascade({"ENDPOINT_NOT_SINGLE": F.col("__filled") != F.array_sort("__ends"), "LOSS_NOT_DECLARED": (F.size("lost") > 0) & (F.col("loss") == "lossless")}, "projected")
    text = lambda c: F.array_join(c, ",").alias(c)
    return out.select("assertion_id", "projection_id", text("kept"), text("endpoints"), text("lost"), "loss", status.alias("status"))


def equivalence_claims(projected: DataFrame) -> DataFrame:
    """assertion_id, projection_id, canonical: only complete projections that lose nothing may stand for the whole assertion."""
    return projected.select("assertion_id", "projection_id", ((F.col("status") == "projected") & (F.col("lost") == "") & (F.col("loss") == "lossless")).alias("canonical"))


def decide_collapse(pairs: DataFrame, collapsing: list[str], symmetric: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """``pairs`` with collapsed. pairs: predicate_a, predicate_b, relation, roles_a, roles_b, names (map of role correspondences), stance_a, stance_b.

    Same predicate or a collapsing relation, participants that match (interchangeable roles in order), and the same stance.
    """
    roles = {"a": F.col("roles_a"), "b": F.col("roles_b")}
    for predicate, (x, y) in (symmetric or {}).items():
        roles = {s: F.when(F.col(f"predicate_{s}") == predicate, interchanged(r, F.lit(x), F.lit(y))).otherwise(r) for s, r in roles.items()}
    linked = (F.col("predicate_a") == F.col("predicate_b")) | F.coalesce(F.col("relation").isin(*collapsing), F.lit(False))
    out = pairs.withColumns({"__a": roles["a"], "__b": roles["b"]})
    same = participants_match(F.col("__a"), F.col("__b"), F.col("names")) & (F.array_sort("stance_a") == F.array_sort("stance_b"))
    return out.withColumn("collapsed", F.coalesce(linked & same, F.lit(False))).drop("__a", "__b")


def triage(expected: Column, blocked: Column, in_scope: Column) -> Column:
    """no_expected_predicates, schema_blocked, out_of_scope or scoreable, in that order."""
    return cascade({"no_expected_predicates": F.size(expected) <= 0, "schema_blocked": blocked, "out_of_scope": ~in_scope}, "scoreable")


def reachability(pairs: DataFrame, relations: DataFrame, collapsing: list[str], modifiers: bool | Column) -> DataFrame:
    """pair_id, bucket: how far a pair of sentences can be told apart or put together by its expected predicates.

    pairs: pair_id, label, failure_mode, predicates_a, predicates_b (arrays, any of them acceptable); relations: from_id, to_id,
    relation, ord, unordered pairs, of several the last by ord holds. ``modifiers``: whether modifier roles and an inflection value are
    declared, as a value or as the scalar of ``modifiers_declared``. A pair labelled same-object counts as linked if any of its pairings of different
    predicates has a collapsing relation.
    """
    a, b = (F.array_sort(F.coalesce(F.col(f"predicates_{s}"), F.array().cast("array<string>"))) for s in "ab")
    df = pairs.select("pair_id", "label", "failure_mode", a.alias("a"), b.alias("b"))
    ends = [F.least("from_id", "to_id").alias("x"), F.greatest("from_id", "to_id").alias("y")]
    last = relations.select(*ends, "relation", "ord").groupBy("x", "y").agg(F.max_by("relation", F.struct("ord", "relation")).alias("relation"))
    pairings = df.filter("label = 'same-object'").select("pair_id", F.explode("a").alias("p"), "b").select("pair_id", "p", F.explode("b").alias("q")).filter("p <> q")
    pairings = pairings.select("pair_id", F.least("p", "q").alias("x"), F.greatest("p", "q").alias("y"))
    linked = pairings.join(last.filter(F.col("relation").isin(*collapsing)), ["x", "y"], "left_semi").select("pair_id", F.lit(True).alias("__linked")).distinct()
    same, equal = F.col("label") == "same-object", F.col("a") == F.col("b")
    bucket = cascade(
        {
            "no_expected_predicates": (F.size("a") == 0) | (F.size("b") == 0),
            "same_via_identical_predicate": same & equal,
            "same_via_declared_relation": same & F.col("__linked"),
            "same_UNREACHABLE": same,
            "diff_via_distinct_predicate": ~equal,
            "diff_via_modifier": (F.col("failure_mode") == "granularity") & F.lit(modifiers),
            "diff_UNREACHABLE": F.col("failure_mode") == "granularity",
        },
        "diff_needs_roles",
    )
    return df.join(linked, "pair_id", "left").select("pair_id", bucket.alias("bucket"))


def modifiers_declared(labels: DataFrame, value_types: DataFrame, needed: list[str], value_type: str) -> DataFrame:
    """declared: one row, whether all ``needed`` modifier labels (column label) and the value type (column value_type_id) are declared."""
    have = labels.filter(F.col("label").isin(*needed)).select("label")
    value = value_types.filter(F.col("value_type_id") == value_type).select(F.lit("").alias("label"))
    return have.unionByName(value).distinct().agg((F.count("*") == len(set(needed)) + 1).alias("declared"))


def dispositions(modules: DataFrame, approved: DataFrame, notice: list[str]) -> DataFrame:
    """path, sha256, header_class, disposition. modules: path, text; approved: path. ``notice``: words of the approved notice.

    Only an approved module may be published; each other one waits for a review of its own, whatever its header says.
    """
    from crosslink.functions.texts import header_class

    out = modules.join(approved.select("path", F.lit(True).alias("__ok")).distinct(), "path", "left").withColumn("__ok", F.coalesce("__ok", F.lit(False)))
    what = F.when(F.col("__ok"), "approved_for_bounded_context").otherwise("excluded_pending_module_specific_review")
    return out.select("path", F.sha2("text", 256).alias("sha256"), header_class(F.col("text"), F.col("__ok"), notice).alias("header_class"), what.alias("disposition"))


def publication_violations(modules: DataFrame, approved: DataFrame, notice: list[str]) -> DataFrame:
    """path, code: what makes a publication fail. approved: path, sha256. An approved module that isn't there, has changed or lacks the notice."""
    found = dispositions(modules, approved, notice).filter("disposition = 'approved_for_bounded_context'").select("path", F.col("sha256").alias("__observed"), "header_class")
    out = approved.select("path", "sha256").join(found, "path", "left")
    code = cascade({"APPROVED_MODULE_ABSENT": F.col("header_class").isNull(), "APPROVED_HASH_CHANGED": F.col("sha256") != F.col("__observed"), "APPROVED_NOTICE_MISSING": F.col("header_class") != "approved_notice"}, "")
    return out.select("path", code.alias("code")).filter("code <> ''")


def module_identity(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """path, code: selected modules that can't be read, or whose SHA-256 or length is not the declared one, whatever their disposition. declared: path, sha256, byte_count; observed: path, sha256, length (as ``scan_files`` gives them)."""
    there = observed.select("path", F.col("sha256").alias("__sha"), F.col("length").alias("__length"))
    changed = (F.col("sha256") != F.col("__sha")) | (F.col("byte_count") != F.col("__length"))
    code = cascade({"MODULE_UNREADABLE": F.col("__sha").isNull(), "MODULE_IDENTITY_CHANGED": changed}, "")
    return declared.join(there, "path", "left").select("path", code.alias("code")).filter("code <> ''")


#: What an approved notice must grant, word for word.
GRANT = ["IEEE hereby grants Licensee", "prepare derivative works", "appropriately acknowledged"]
#: The lines of an attribution; commit, path, sha256, acknowledgement and notice are put in.
ATTRIBUTION = """SUMO bounded linguistic context
Source: https://github.com/ontologyportal/sumo at {commit}
Source module: {path} ({sha256})
Acknowledgement: {acknowledgement}
Only derived bounded facts are packaged; the raw module and full projection are not.

Exact source license notice:
"""


def attributions(modules: DataFrame, approved: DataFrame, commit: str, phrases: list[str] = GRANT) -> DataFrame:
    """path, code, attribution, notice_sha256 for approved modules: the acknowledgement with the exact lines of the notice.

    modules: path, text; approved: path, sha256, acknowledgement, first_line, last_line (from 1). The lines lose their trailing
    blanks. code is null where all is well; else the attribution is: MODULE_ABSENT, NOTICE_RANGE (the module has fewer lines),
    GRANT_MISSING (one of ``phrases`` is not in the notice).
    """
    from crosslink.functions.texts import missing_phrases

    rows = approved.join(modules.select("path", "text"), "path", "left").withColumn("__lines", F.split("text", r"\r\n|\r|\n"))
    part = F.transform(F.slice("__lines", F.col("first_line"), F.col("last_line") - F.col("first_line") + 1), lambda x: F.regexp_replace(x, r"\s+$", ""))
    ended = F.size("__lines") - F.when(F.element_at("__lines", -1) == "", 1).otherwise(0)  # a line break at the end begins no line
    rows = rows.withColumn("__notice", F.when(ended >= F.col("last_line"), F.concat(F.array_join(part, "\n"), F.lit("\n"))))
    code = cascade({"MODULE_ABSENT": F.col("text").isNull(), "NOTICE_RANGE": F.col("__notice").isNull(), "GRANT_MISSING": F.size(missing_phrases(F.col("__notice"), phrases)) > 0}, "")
    text = F.lit(ATTRIBUTION.replace("{commit}", commit))
    for name in ("sha256", "acknowledgement", "path"):
        text = F.replace(text, F.lit(f"{{{name}}}"), F.coalesce(F.col(name).cast("string"), F.lit("")))
    fine = code == ""
    return rows.select("path", F.nullif(code, F.lit("")).alias("code"), F.when(fine, F.concat(text, "__notice")).alias("attribution"), F.when(fine, F.sha2("__notice", 256)).alias("notice_sha256"))


def completeness(parsed: Column, repaired: Column, issues: Column) -> Column:
    return F.when(issues > 0, "incomplete").when(repaired > 0, "complete_with_repairs").otherwise("complete")


def unused_repairs(repairs: DataFrame, applied: DataFrame) -> DataFrame:
    return repairs.join(applied.select("repair_id").distinct(), "repair_id", "left_anti")


def schema_profile(roles: DataFrame) -> DataFrame:
    """schema_id, n_roles, grounded, ungrounded, repeatable. roles: schema_id, grounded_role, max_count (null: no limit)."""
    n = lambda c: F.count_if(c).cast("long")
    return roles.groupBy("schema_id").agg(F.count("*").alias("n_roles"), n(F.col("grounded_role").isNotNull()).alias("grounded"), n(F.col("grounded_role").isNull()).alias("ungrounded"), n(F.coalesce(F.col("max_count") > 1, F.lit(True))).alias("repeatable"))


def contact_states(observations: DataFrame) -> DataFrame:
    """episode, state, confidence, evidence (sorted ids). observations: episode, obs_id, ord, channel, ts, value, z, reference.

    Pressure: touching before and not after, or the reverse, is a transient contact; a stable mean over 1 is a direct one. A position
    more than 0.02 over the reference surface rules contact out, whatever the pressure says. Null readings and times count as 0.
    """
    known = ["pressure_sensor", "position_tracker", "camera_overhead", "camera_3d_stereo", "accelerometer"]
    value, z, channel = F.coalesce("value", F.lit(0.0)), F.coalesce("z", F.lit(0.0)), F.col("channel")
    pressure = channel == "pressure_sensor"
    order = F.when(pressure, F.struct(F.coalesce("ts", F.lit(0)).alias("ts"), value.alias("value")))
    one = observations.groupBy("episode").agg(
        exact_mean(F.when(pressure, value)).alias("mean"),
        F.max(F.when(pressure, value)).alias("high"),
        F.min(F.when(pressure, value)).alias("low"),
        F.min(order)["value"].alias("first"),
        F.max(order)["value"].alias("last"),
        exact_mean(F.when(channel == "position_tracker", z)).alias("height"),
        F.min_by("reference", F.when(F.col("reference").isNotNull(), F.col("ord"))).alias("surface"),
        F.array_sort(F.collect_list(F.when(channel.isin(*known), F.col("obs_id")))).alias("evidence"),
    )
    apart = F.contains("surface", F.lit("surface_B_height_0.1m")) & (F.col("height") - 0.1 > 0.02)
    turned = (F.col("first") > 1.0) != (F.col("last") > 1.0)
    direct = (F.col("mean") > 1.0) & (F.col("high") - F.col("low") < 1.0)
    state = F.when(apart, "no_contact").when(turned, "transient_contact").when(direct, "direct_contact").otherwise("unknown")
    sure = F.when(apart, 0.94).when(turned, 0.92).when(direct, 0.95).otherwise(0.5)
    return one.select("episode", state.alias("state"), sure.alias("confidence"), "evidence")


def classify_episodes(episodes: DataFrame, contacts: DataFrame, identities: DataFrame, gap_ms: int = 3000) -> DataFrame:
    """episode, classification, confidence, by the type of the episode.

    episodes: episode, episode_type; contacts: ``contact_states``; identities: episode, max_gap_ms, instance_count (null: unknown).
    """
    df = episodes.select("episode", "episode_type").join(contacts.select("episode", "state", F.col("confidence").alias("__sure")), "episode", "left").join(identities, "episode", "left")
    kind, state = F.col("episode_type"), F.coalesce("state", F.lit("unknown"))
    cases = [
        ((kind == "support") & (state == "direct_contact") & (F.col("__sure") > 0.90), "support", 0.98),
        ((kind == "support") & (state == "direct_contact"), "support", 0.75),
        ((kind == "obstruction") & (state == "no_contact"), "visual_occlusion_not_support", 0.97),
        ((kind == "attachment") & (state == "transient_contact"), "transient_contact_not_attachment", 0.96),
        (kind == "posture_persistence", "persistent_identity_stable_pose", 0.95),
        ((kind == "posture_identity_adversarial") & (F.col("max_gap_ms") > gap_ms), "identity_unknown_insufficient_evidence", 0.99),
        ((kind == "posture_identity_adversarial") & (F.col("instance_count") > 1), "multiple_indistinguishable_instances", 0.98),
        (kind == "posture_identity_adversarial", "persistent_identity_stable_pose", 0.95),
    ]
    name = F.coalesce(*[F.when(c, F.lit(v)) for c, v, _ in cases], F.lit("support"))
    sure = F.coalesce(*[F.when(c, F.lit(p)) for c, _, p in cases], F.lit(0.5))
    return df.select("episode", name.alias("classification"), sure.alias("confidence"))
