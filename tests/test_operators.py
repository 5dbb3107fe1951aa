import pytest
from pyspark.sql import functions as F

from crosslink.operators import catalog, checks, graph, match, metrics, rules, windows
from crosslink.operators.graph import ancestor_closure


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_role_audit(spark):
    edges = spark.createDataFrame([("Physical", "Entity"), ("Process", "Physical"), ("Leaving", "Process"), ("Object", "Physical"), ("AutonomousAgent", "Object")], "child string, parent string")
    relations = spark.createDataFrame([("agent", True), ("patient", True), ("manner", True), ("processRole", True), ("ordinaryRelation", False)], "relation string, is_case_role boolean")
    types = ancestor_closure(edges).select(F.col("node").alias("type")).distinct()
    constraints = spark.createDataFrame([("agent", "AutonomousAgent"), ("patient", "Entity"), ("processRole", "Process")], "relation string, required_type string")
    slots = [
        ("abandon", "Agent", "agent", "AutonomousAgent", "exact_case_role", "exact_current_source", "direct_match"),
        ("abandon", "Theme", "patient", "Entity", "exact_case_role", "exact_current_source", "direct_match"),
        ("abandon", "Location", None, "Object", "unmapped", "exact_current_source", "not_applicable"),
        ("missing", "Mismatch", "patient", "Object", "exact_case_role", "exact_current_source", "compatible_donor_subtype"),
        ("missing", "Supertype", "agent", "Object", "exact_case_role", "exact_current_source", "incompatible_donor_supertype"),
        ("missing", "Incomparable", "processRole", "Object", "exact_case_role", "exact_current_source", "incomparable_types"),
        ("missing", "Absent", "manner", "Entity", "exact_case_role", "exact_current_source", "no_direct_constraint"),
        ("missing", "Missing", "missingRole", "MissingType", "missing_current_source", "missing_current_source", "not_applicable"),
        ("unmapped", "NonCase", "ordinaryRelation", None, "exact_non_case_relation", "unmapped", "not_applicable"),
    ]
    df = spark.createDataFrame([s[:4] for s in slots], "predicate string, label string, role string, type string")
    got = match.audit_roles(df, relations, types, constraints, ancestor_closure(edges))
    assert rows(got) == set(slots)
    two = spark.createDataFrame([("agent", "AutonomousAgent"), ("agent", "Process")], "relation string, required_type string")
    assert {r.constraint_status for r in match.audit_roles(df.filter("label = 'Agent'"), relations, types, two, ancestor_closure(edges)).collect()} == {"incomparable_types"}


@pytest.mark.parametrize("a,b,want", [("supports", "supports", "tentatively_verified"), ("contradicts", "contradicts", "rejected"), ("supports", "contradicts", "unresolved"), ("abstain", "abstain", "unresolved"), (None, "supports", "unresolved")])
def test_two_pass(spark, a, b, want):
    assert spark.range(1).select(rules.two_pass(F.lit(a).cast("string"), F.lit(b).cast("string"))).first()[0] == want


def test_closure_of_cycle(spark):
    cycle = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "a"), (None, "a")], "child string, parent string")
    got = rows(ancestor_closure(cycle))
    assert got == {(x, y) for x in "abc" for y in "abc"} | {("x", y) for y in "xabc"}
    assert rows(graph.reaches_root(cycle, cycle.select(F.col("child").alias("id")).filter("id is not null"))) == {(x, False) for x in "abcx"}
    assert ancestor_closure(cycle.filter("false")).count() == 0


def test_shortest_paths(spark):
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "e"), ("e", "a")], "child string, parent string")
    pairs = spark.createDataFrame([("a", "d"), ("a", "b"), ("d", "d"), ("b", "z")], "start string, target string")
    got = {(r.start, r.target): (r.length, r.n_paths, r.path) for r in graph.shortest_paths(edges, pairs).collect()}
    assert got == {("a", "d"): (2, 2, None), ("a", "b"): (1, 1, ["a", "b"]), ("d", "d"): (0, 1, ["d"])}


def test_catalog_and_corruption(spark):
    p = spark.createDataFrame([("Leave", "go", "pb", 1), ("leave ", "again", "pb", 2), ("Stay", "x", "pb", 3)], "name string, description string, source string, ord int")
    s = spark.createDataFrame([("Leave", "Agent", "Object", 1, 1), ("Leave", " ", "Object", 0, 2), ("Gone", "Agent", None, 0, 3), ("Stay", "Agent", None, 0, 4)], "name string, label string, type string, required int, ord int")
    h = spark.createDataFrame([("Object", "Physical"), ("Physical", "Entity"), ("Process", "Physical")], "child string, parent string")
    t = catalog.compile_catalog(p, s, h)
    assert rows(t["predicate_types"]) == {("lc:leave", "Leave", "go"), ("lc:stay", "Stay", "x")}
    assert rows(t["hierarchy_edges"]) == {("Object", "Physical"), ("Physical", "Entity")}
    assert rows(t["rejected_slots"]) == {("lc:leave", " ", "blank_label"), ("lc:gone", "Agent", "unknown_predicate")}
    keys = {"predicate_types": ["predicate_id"], "predicate_role_edges": ["predicate_id", "role_id"]}
    refs = [("predicate_role_edges", "predicate_id", "predicate_types", "predicate_id"), ("constraints", "role_id", "role_types", "role_id")]
    assert checks.catalog_violations(t, keys, refs).count() == 0
    broken = t | {"predicate_types": t["predicate_types"].filter("predicate_id <> 'lc:stay'"), "predicate_role_edges": t["predicate_role_edges"].unionByName(t["predicate_role_edges"])}
    assert {(r.asset, r.code) for r in checks.catalog_violations(broken, keys, refs).collect()} == {("predicate_role_edges", "DUPLICATE_KEY"), ("predicate_role_edges", "DANGLING_PREDICATE_ID")}


def test_quantiles_and_grid(spark):
    df = spark.createDataFrame([(float(i), "a") for i in range(101)], "v double, k string")
    out = windows.percentile_normalized(df, ["k"], "v").filter("v in (0, 5, 50, 95, 100)").orderBy("v")
    assert [r.normal for r in out.collect()] == [0.0, 0.0, 0.5, 1.0, 1.0]
    ten = spark.createDataFrame([("a", 0.0), ("a", 10.0)], "label string, v double")
    assert tuple(metrics.calibrate(ten, "label", "v", {"q": ("a", 0.25), "r": ("a", 0.9)}).first()) == (2.5, 9.0)
    w = spark.createDataFrame([(0.9, "contact"), (0.5, "contact"), (0.1, "no_contact"), (0.5, "no_contact")], "v double, ref string")
    best = metrics.grid_search(w, "v", "ref", [0.5], 0.05, "contact", "no_contact").first()
    assert (best.balanced_accuracy, best.coverage, best.refusals, best.covered_accuracy) == (0.5, 0.5, 2, 1.0)
    tie = metrics.grid_search(w.filter("v <> 0.5"), "v", "ref", [0.30, 0.50], 0.05, "contact", "no_contact")
    assert metrics.best_of_grid(tie).first().center == 0.30
    one = metrics.grid_search(w.filter("ref = 'contact'"), "v", "ref", [0.5], 0.05, "contact", "no_contact").first()
    assert one.balanced_accuracy is None and metrics.best_of_grid(metrics.grid_search(w.filter("false"), "v", "ref", [0.5], 0.05, "contact", "no_contact")).count() == 0


def test_spearman_and_bands(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 2.0), ("a", 2.0, 5.0), ("b", 1.0, 1.0), ("b", 2.0, 1.0), ("a", None, 9.0)], "k string, x double, y double")
    got = {r.k: (r.n, r.rho) for r in metrics.spearman(df, "x", "y", ["k"]).collect()}
    assert got["b"] == (2, None) and got["a"][0] == 3 and abs(got["a"][1] - 0.5) < 1e-12
    bands = metrics.band_histogram(df.withColumn("bad", F.lit(True)), "x", "bad", [("low", 0.0, 1.0), ("high", 1.5, 2.0)])
    assert rows(bands) == {("low", 2, 1.0), ("high", 3, 1.0)}


def test_checks(spark):
    df = spark.createDataFrame([("a", " ", 1.5, 2), ("b", "x", float("nan"), 1), ("c", None, None, None)], "id string, name string, conf double, flag int")
    got = checks.field_violations(df, "id", {"BLANK": checks.blank(F.col("name")), "CONF": checks.no_confidence(F.col("conf")), "FLAG": checks.no_flag(F.col("flag"))})
    assert rows(got) == {("a", "BLANK"), ("a", "CONF"), ("a", "FLAG"), ("b", "CONF"), ("c", "BLANK"), ("c", "FLAG")}
    bag = lambda *x: spark.createDataFrame([(v,) for v in x], "k string")
    assert rows(checks.multiset_difference(bag("a", "a", None), bag("a", None, "b"), ["k"])) == {("a", 2, 1), ("b", 0, 1)}
    assert rows(checks.replay_difference(bag("a", "a"), bag("a", "b"))) == {("a", "stored"), ("b", "recomputed")}
    assert rows(checks.population_difference(bag("a", "c"), bag("a", "b"), "k")) == {("c", "left"), ("b", "right")}
    with pytest.raises(ValueError):
        checks.non_empty(bag("a").filter("false"), "bag")
    assert checks.non_empty(bag("a"), "bag").count() == 1


def test_intervals_and_margins(spark):
    parts = spark.createDataFrame([("k", 0.0, 10.0, "stance"), ("k", 10.0, 20.0, "swing")], "k string, start double, end double, label string")
    w = spark.createDataFrame([("k", 1.0, 9.0), ("k", 1.0, 9.5), ("k", 0.5, 5.0), ("k", 11.0, 19.0), ("j", 1.0, 2.0)], "k string, start double, end double")
    got = rows(windows.windows_in_intervals(w, parts, ["k"], 1.0))
    assert got == {("k", 1.0, 9.0, "stance"), ("k", 1.0, 9.5, None), ("k", 0.5, 5.0, None), ("k", 11.0, 19.0, "swing"), ("j", 1.0, 2.0, None)}
    seg = spark.createDataFrame([(0, 9, 100), (0, 300, 250), (5, 5, 100)], "start int, end int, total int")
    assert rows(windows.central_window(seg, "total")) == {(0, 9, 100, 0, 10), (0, 300, 250, 61, 189)}


def test_reviews_profiles_transforms(spark):
    q = spark.createDataFrame([("c1", "p", "A"), ("c2", "p", "B"), ("c3", "q", "A")], "case_id string, predicate_id string, label string")
    slots = spark.createDataFrame([("p", "A"), ("p", "B")], "predicate_id string, label string")
    got = match.bind_reviews(q, slots, spark.createDataFrame([("A", "r1")], "label string, role_id string"))
    assert {(r.case_id, r.role_id, r.status) for r in got.collect()} == {("c1", "r1", "bound"), ("c2", None, "missing_role"), ("c3", None, "missing_slot")}
    t = spark.createDataFrame([("1", "p", "a", "q", "b"), ("2", "p", "x", "q", "b"), ("3", "p", "a", "q", "y"), ("4", "q", "b", "p", "a")], "case_id string, from_id string, from_role string, to_id string, to_role string")
    s = spark.createDataFrame([("p", "a"), ("q", "b")], "predicate_id string, role string")
    got = match.transform_evidence(t, s, t.filter("case_id = '1'"))
    assert {(r.case_id, r.status) for r in got.collect()} == {("1", "bound"), ("2", "missing_source_role"), ("3", "missing_target_role"), ("4", "missing_correspondence")}


def test_inspection(spark):
    p = spark.createDataFrame([("p", "leave")], "predicate_id string, label string")
    r = spark.createDataFrame([("p", 2, "b", False), ("p", 1, "a", True)], "predicate_id string, ord int, role string, required boolean")
    m = spark.createDataFrame([("p", "frames", "f2"), ("p", "frames", "f1"), ("p", "types", "t")], "predicate_id string, family string, source_id string")
    got = match.inspect_predicates(p, r, m).first()
    assert [x.role for x in got.roles] == ["a", "b"] and got.mappings == {"frames": ["f1", "f2"], "types": ["t"]}
    lin = spark.createDataFrame([("c", "s1", "x"), ("c", "s2", "y"), ("d", "s1", "z")], "canonical_id string, source_key string, source_id string")
    out = match.inspect_lineage(lin, spark.createDataFrame([("s1", "first")], "source_key string, description string"), canonical_id="c")
    assert {(r.source_id, r.source_description, r.status) for r in out.collect()} == {("x", "first", "declared"), ("y", None, "undeclared_source")}
    assert match.inspect_lineage(lin, lin.select("source_key", F.lit("d").alias("description")).distinct(), source_id="z").count() == 1


def test_small_rules(spark):
    one = spark.range(1)
    assert one.select(rules.completeness(F.lit(3), F.lit(1), F.lit(0)), rules.completeness(F.lit(3), F.lit(0), F.lit(2)), rules.completeness(F.lit(3), F.lit(0), F.lit(0))).first()[:] == ("complete_with_repairs", "incomplete", "complete")
    ids = lambda *x: spark.createDataFrame([(v,) for v in x], "repair_id string")
    assert rows(rules.unused_repairs(ids("a", "b"), ids("a"))) == {("b",)}
    axioms = spark.createDataFrame([("a", "b", "m"), ("b", "c", "m"), ("b", "c", "n")], "child string, parent string, module string")
    path = spark.createDataFrame([(1, ["a", "b", "c"]), (2, ["a"])], "path_id int, path array<string>")
    assert rows(graph.verified_path_edges(path, axioms, "m")) == {(1, 0, "a", "b", True), (1, 1, "b", "c", False)}
    lineage = spark.createDataFrame([("v2", "v2", "ok"), ("v2", "v1", "ok")], "version string, ancestor string, status string")
    assets = spark.createDataFrame([("v1", 1), ("v2", 2), ("v3", 3)], "version string, x int")
    assert rows(graph.union_lineage(assets, lineage, "v2")) == {("v1", 1), ("v2", 2)}


def mapping(spark, **changes):
    """One mapping request from give to its partner predicates; the changes make it fail."""
    base = {
        "from_id": "sell", "to_id": "transfer", "from_roles": {"agent": "a", "theme": "t"}, "to_roles": {"giver": "a", "object": "t"},
        "transforms": [("agent", "giver"), ("theme", "object")], "from_scope": "actual", "to_scope": "actual", "loss": "lossy",
        "conditions": ["commercial_transaction"], "level": "occurrence", "from_identity": (1, 2, 3, 4), "to_identity": (1, 2, 9, 9),
    }
    c = base | changes
    fields = "struct<proposition_id:int,occurrence_id:int,assertion_id:int,support_record_id:int>"
    schema = f"case_id string, from_id string, to_id string, from_roles map<string,string>, to_roles map<string,string>, transforms array<struct<from_role:string,to_role:string>>, from_scope string, to_scope string, loss string, conditions array<string>, identity_level string, from_identity {fields}, to_identity {fields}"
    return spark.createDataFrame([("c", *c.values())], schema)


@pytest.mark.parametrize(
    "changes,want",
    [
        ({}, "narrowerThan"),
        ({"from_id": "x"}, "UNKNOWN_PREDICATE"),
        ({"from_roles": {"agent": "a", "other": "t"}}, "UNDECLARED_PREDICATE_ROLE"),
        ({"from_id": "transfer", "to_id": "sell", "from_roles": {"giver": "a"}, "to_roles": {"agent": "a"}, "transforms": [("giver", "agent")]}, "MAPPING_DIRECTION_UNSUPPORTED"),
        ({"to_id": "walk", "to_roles": {}, "transforms": []}, "PREDICATE_MAPPING_UNSUPPORTED"),
        ({"loss": "lossless"}, "NARROWER_PROJECTION_REQUIRES_LOSSY_CONTRACT"),
        ({"conditions": []}, "MAPPING_CONDITION_MISSING"),
        ({"to_id": "vend", "to_roles": {"agent": "a", "theme": "t"}, "transforms": [("agent", "agent"), ("theme", "theme")], "conditions": []}, "CLOSE_MATCH_REQUIRES_CONTEXTUAL_REVIEW"),
        ({"to_id": "vend", "to_roles": {"agent": "a", "theme": "t"}, "transforms": [("agent", "agent"), ("theme", "theme")], "conditions": ["contextual_equivalence_reviewed"]}, "ROLE_TRANSFORM_UNSUPPORTED"),
        ({"to_id": "sell", "to_roles": {"agent": "a", "theme": "t"}, "transforms": [("agent", "agent"), ("theme", "theme")]}, "IDENTITY_MAPPING_MUST_BE_LOSSLESS"),
        ({"to_id": "sell", "to_roles": {"agent": "a", "theme": "t"}, "transforms": [("agent", "agent"), ("theme", "theme")], "loss": "lossless"}, "identity"),
        ({"to_id": "own", "to_roles": {"agent": "a"}, "transforms": [("agent", "agent")]}, "RELATION_NOT_EXECUTABLE"),
        ({"transforms": [("agent", "giver"), ("agent", "object")]}, "DUPLICATE_SOURCE_ROLE_TRANSFORM"),
        ({"transforms": [("agent", "giver")]}, "ROLE_TRANSFORM_SOURCE_COVERAGE_MISMATCH"),
        ({"transforms": [("agent", "giver"), ("theme", "giver")]}, "ROLE_TRANSFORM_TARGET_COVERAGE_MISMATCH"),
        ({"transforms": [("agent", "object"), ("theme", "giver")]}, "ROLE_TRANSFORM_UNSUPPORTED"),
        ({"to_roles": {"giver": "b", "object": "t"}}, "ROLE_FILLER_MISMATCH"),
        ({"to_scope": "negated"}, "SCOPE_MISMATCH"),
        ({"to_scope": "negated", "conditions": ["commercial_transaction", "compare_embedded_proposition"]}, "SCOPE_MISMATCH"),
        ({"to_scope": "negated", "conditions": ["commercial_transaction", "compare_embedded_proposition"], "level": "proposition"}, "narrowerThan"),
        ({"level": "assertion"}, "IDENTITY_MISMATCH"),
        ({"level": "proposition", "to_identity": (7, 2, 3, 4)}, "IDENTITY_MISMATCH"),
    ],
)
def test_mapping_rules(spark, changes, want):
    names = lambda *x: spark.createDataFrame([(v,) for v in x], "id string")
    preds = names("sell", "transfer", "vend", "own", "walk")
    roles = spark.createDataFrame([("sell", "agent"), ("sell", "theme"), ("transfer", "giver"), ("transfer", "object"), ("vend", "agent"), ("vend", "theme"), ("own", "agent")], "predicate_id string, role string")
    rel = spark.createDataFrame([("sell", "transfer", "narrowerThan", 1), ("sell", "transfer", "closeMatch", 2), ("sell", "vend", "closeMatch", 1), ("sell", "own", "entails", 1)], "from_id string, to_id string, relation string, ord int")
    corr = spark.createDataFrame([("sell", "agent", "transfer", "giver", "narrowerThan", 1), ("sell", "theme", "transfer", "object", "narrowerThan", 1), ("sell", "agent", "vend", "agent", "narrowerThan", 1)], "from_id string, from_role string, to_id string, to_role string, via_relation string, ord int")
    got = rules.evaluate_mappings(mapping(spark, **changes), preds, roles, rel, corr).collect()
    assert [(r.case_id, r.status, r.reason) for r in got] == [("c", "rejected" if want.isupper() else "allowed", want)]


def test_nested_fillers(spark):
    a = spark.createDataFrame([("x", "s"), ("y", "s"), ("z", "t")], "assertion_id string, schema_id string")
    roles = spark.createDataFrame([("s", "any", None), ("s", "only_t", "t")], "schema_id string, role_id string, filler_schema string")
    rows_ = [("x", "any", "assertion", "y"), ("x", "any", "assertion", "x"), ("x", "any", "assertion", "gone"), ("x", "only_t", "assertion", "z"), ("x", "only_t", "assertion", "y"), ("x", "only_t", "entity", "e"), ("x", "any", "entity", "e"), ("x", "none", "entity", "e")]
    got = rules.nested_filler_violations(a, spark.createDataFrame(rows_, "assertion_id string, role_id string, filler_kind string, filler_id string"), roles)
    assert rows(got) == {("x", "any", "x", "SELF_REFERENCE"), ("x", "any", "gone", "MISSING_ASSERTION"), ("x", "only_t", "y", "WRONG_SCHEMA"), ("x", "only_t", "e", "ASSERTION_EXPECTED"), ("x", "none", "e", "UNDECLARED_ROLE")}


def test_reachability(spark):
    pairs = [
        (1, "same-object", "x", ["a"], []), (2, "same-object", "x", ["a", "b"], ["b", "a"]), (3, "same-object", "x", ["a", "b"], ["c"]), (4, "same-object", "x", ["a"], ["d"]),
        (5, "different", "granularity", ["a"], ["b"]), (6, "different", "granularity", ["a"], ["a"]), (7, "different", "roles", ["a"], ["a"]),
    ]
    df = spark.createDataFrame(pairs, "pair_id int, label string, failure_mode string, predicates_a array<string>, predicates_b array<string>")
    rel = spark.createDataFrame([("c", "b", "closeMatch", 1), ("a", "d", "closeMatch", 1), ("d", "a", "related", 2)], "from_id string, to_id string, relation string, ord int")
    want = ["no_expected_predicates", "same_via_identical_predicate", "same_via_declared_relation", "same_UNREACHABLE", "diff_via_distinct_predicate", "diff_via_modifier", "diff_needs_roles"]
    bucket = lambda m: [r.bucket for r in rules.reachability(df, rel, ["closeMatch"], m).orderBy("pair_id").collect()]
    assert bucket(True) == want and bucket(False) == [*want[:5], "diff_UNREACHABLE", want[6]]
    labels = spark.createDataFrame([("M",), ("N",), (None,)], "label string")
    value = spark.createDataFrame([("v",)], "value_type_id string")
    declared = lambda need, v: rules.modifiers_declared(labels, value, need, v).first().declared
    assert (declared(["M", "N"], "v"), declared(["M", "X"], "v"), declared(["M"], "w")) == (True, False, False)


def test_contacts_and_episodes(spark):
    obs = [
        ("touch", 1, 1, "pressure_sensor", 0, 2.0, None, None), ("touch", 2, 2, "pressure_sensor", 5, 2.9, None, None), ("touch", 3, 3, "thermometer", 5, 2.9, None, None),
        ("turn", 4, 1, "pressure_sensor", 9, 0.1, None, None), ("turn", 5, 2, "pressure_sensor", 1, 3.0, None, None),
        ("apart", 6, 1, "pressure_sensor", 1, 3.0, None, None), ("apart", 7, 2, "position_tracker", 1, None, 0.13, "surface_B_height_0.1m"),
        ("noisy", 8, 1, "pressure_sensor", 1, 2.0, None, None), ("noisy", 9, 2, "pressure_sensor", 2, 3.5, None, None),
        ("seen", 10, 1, "camera_overhead", None, None, None, "floor"), ("seen", 11, 2, "position_tracker", None, None, 9.0, "surface_B_height_0.1m"),
    ]
    df = spark.createDataFrame(obs, "episode string, obs_id int, ord int, channel string, ts long, value double, z double, reference string")
    contacts = rules.contact_states(df)
    assert {r.episode: (r.state, r.confidence) for r in contacts.collect()} == {"touch": ("direct_contact", 0.95), "turn": ("transient_contact", 0.92), "apart": ("no_contact", 0.94), "noisy": ("unknown", 0.5), "seen": ("unknown", 0.5)}
    assert {r.episode: r.evidence for r in contacts.collect()}["touch"] == [1, 2]
    kinds = {"touch": "support", "turn": "attachment", "apart": "obstruction", "noisy": "support", "seen": "posture_identity_adversarial", "p1": "posture_identity_adversarial", "p2": "posture_identity_adversarial", "p3": "posture_persistence", "o": "odd"}
    episodes = spark.createDataFrame(list(kinds.items()), "episode string, episode_type string")
    ident = spark.createDataFrame([("p1", 3001, 1), ("p2", 3000, 2), ("seen", None, None)], "episode string, max_gap_ms int, instance_count int")
    got = {r.episode: (r.classification, r.confidence) for r in rules.classify_episodes(episodes, contacts, ident).collect()}
    assert got == {
        "touch": ("support", 0.98), "turn": ("transient_contact_not_attachment", 0.96), "apart": ("visual_occlusion_not_support", 0.97), "noisy": ("support", 0.5), "seen": ("persistent_identity_stable_pose", 0.95),
        "p1": ("identity_unknown_insufficient_evidence", 0.99), "p2": ("multiple_indistinguishable_instances", 0.98), "p3": ("persistent_identity_stable_pose", 0.95), "o": ("support", 0.5),
    }


def test_contacts_at_the_limit(spark):
    """Many equal readings have that reading as their mean: 0.12 is not more than 0.02 over 0.1, though nine of them added up as doubles are."""
    obs = [("e", n, n, "position_tracker", n, None, 0.12, "surface_B_height_0.1m") for n in range(9)]
    df = spark.createDataFrame(obs, "episode string, obs_id int, ord int, channel string, ts long, value double, z double, reference string").coalesce(1)
    contacts = rules.contact_states(df)
    assert [(r.state, r.confidence) for r in contacts.collect()] == [("unknown", 0.5)]
    episodes, seen = spark.createDataFrame([("e", "obstruction")], "episode string, episode_type string"), spark.createDataFrame([], "episode string, max_gap_ms int, instance_count int")
    assert [tuple(r) for r in rules.classify_episodes(episodes, contacts, seen).collect()] == [("e", "support", 0.5)]



def test_mapping_records(spark):
    good = [("predicate_type", "derived_from", "donor", None, None, None), ("predicate_type", "candidate_alignment", "framenet_candidate", "m", "unknown", 0.5), ("role_slot", "positional_role", "propbank", None, None, None), ("hierarchy_edge", "subtype_of", "sumo_types", None, None, None)]
    bad = {
        "RELATION_OF_KIND": ("role_slot", "derived_from", "donor", None, None, None), "METHOD_WITHOUT_SCOPE": ("predicate_type", "candidate_alignment", "framenet_candidate", "m", None, None),
        "METHOD_OF_NO_CANDIDATE": ("predicate_type", "derived_from", "donor", "m", "unknown", None), "CONFIDENCE_OF_NO_CANDIDATE": ("role_slot", "positional_role", "donor", None, None, 0.1),
        "UNKNOWN_SOURCE": ("role_slot", "positional_role", "x", None, None, None), "RELATION_OF_SOURCE": ("predicate_type", "candidate_alignment", "donor", None, None, None),
    }
    df = spark.createDataFrame([(str(i), *g) for i, g in enumerate(good)] + [(k, *v) for k, v in bad.items()], "id string, canonical_kind string, relation string, source_key string, method_ref string, method_scope string, confidence double")
    assert rows(checks.mapping_violations(df, "id")) == {(k, k) for k in bad}


def test_publication(spark):
    import hashlib

    text = "Example grants: prepare derivative works. GNU General Public License"
    sha = hashlib.sha256(text.encode()).hexdigest()
    modules = spark.createDataFrame([("a", text), ("b", text), ("c", "GNU General Public License")], "path string, text string")
    approved = spark.createDataFrame([("a", sha), ("c", hashlib.sha256(b"GNU General Public License").hexdigest()), ("gone", "-")], "path string, sha256 string")
    notice = ["example grants", "prepare derivative works"]
    got = {r.path: (r.header_class, r.disposition) for r in rules.dispositions(modules, approved, notice).collect()}
    yes, no = "approved_for_bounded_context", "excluded_pending_module_specific_review"
    assert got == {"a": ("approved_notice", yes), "b": ("gpl", no), "c": ("gpl", yes)}
    assert rows(rules.publication_violations(modules, approved, notice)) == {("c", "APPROVED_NOTICE_MISSING"), ("gone", "APPROVED_MODULE_ABSENT")}
    changed = approved.replace(sha, "0", ["sha256"])
    assert ("a", "APPROVED_HASH_CHANGED") in rows(rules.publication_violations(modules, changed, notice))


def test_long_paths_are_followed(spark):
    n = 90
    edges = spark.range(n).selectExpr("id as child", "id + 1 as parent")
    pairs = spark.createDataFrame([(0, n)], "start long, target long")
    got = graph.shortest_paths(edges, pairs).collect()
    assert [(r.length, r.n_paths, len(r.path)) for r in got] == [(n, 1, n + 1)]
    assert graph.shortest_paths(edges, pairs.filter("false")).count() == 0
    assert graph.ancestor_closure(edges, reflexive=False).count() == n * (n + 1) // 2


def test_closure_delta_is_the_full_closure(spark):
    import random

    rnd = random.Random(4)
    frame = lambda pairs: spark.createDataFrame(pairs, "child int, parent int")
    for n, m in ((6, 8), (25, 40)):
        every = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)]  # with cycles, loops and repeats
        old, new = every[: m // 2], every[m // 2 :]
        for reflexive in (True, False):
            stored = graph.ancestor_closure(frame(old), reflexive)
            added = rows(graph.closure_delta(stored, frame(new), reflexive))
            assert rows(stored) | added == rows(graph.ancestor_closure(frame(every), reflexive)) and not rows(stored) & added
    stored = graph.ancestor_closure(frame(old))
    assert graph.closure_delta(stored, frame(old)).isEmpty() and graph.closure_delta(stored, frame(old).filter("false")).isEmpty()
    assert rows(graph.closure_delta(stored.filter("false"), frame(every))) == rows(graph.ancestor_closure(frame(every)))


def test_slice_takes_what_no_ancestor_owns(spark):
    frame = spark.createDataFrame
    rel = frame([("likes", 2, "m"), ("owns", 1, "m")], "relation string, arity int, module string")
    cons = frame([("likes", 1, "Human", "m"), ("likes", 2, "Object", "m"), ("owns", 1, "Robot", "m")], "relation string, position int, required_type string, module string")
    hierarchy = frame([("Human", "Agent"), ("Agent", "Object"), ("Object", "Entity"), ("Robot", "Agent"), ("Rock", "Object"), ("Human", "Agent")], "child string, parent string")
    id_ = lambda x: f"lc:sumo_type.{x.lower()}"
    owned = {"predicates": frame([("lc:owns",)], "predicate_id string"), "roles": frame([], "role_id string"), "types": frame([(id_("Object"),), (id_("Entity"),)], "type_id string"), "edges": frame([(id_("Object"), id_("Entity"))], "child_id string, parent_id string")}
    got = catalog.compile_additive_slice(rel, cons, frame([("m", "approved")], "module string, disposition string"), owned, hierarchy)
    assert rows(got["hierarchy_edges"]) == {("subtype_of", id_("Human"), id_("Agent")), ("subtype_of", id_("Agent"), id_("Object"))}
    assert rows(got["entity_types"]) == {(id_("Human"), "Human"), (id_("Agent"), "Agent")}  # not Robot, whose relation an ancestor owns
    stored = graph.ancestor_closure(hierarchy)
    again = catalog.compile_additive_slice(rel, cons, frame([("m", "approved")], "module string, disposition string"), owned, hierarchy, stored)
    assert rows(again["hierarchy_edges"]) == rows(got["hierarchy_edges"])


def test_labels_of_several_words(spark):
    import re

    rnd = __import__("random").Random(8)
    words = ["the", "of", "a", "red", "blue", "big", "rare1", "rare2", "rare3"]
    rows_ = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 3))), "; ".join(" ".join(rnd.choice(words).title() for _ in range(rnd.randint(0, 5))) for _ in range(2))) for i in range(90)]
    rows_ += [(200, "the", "the other is the"), (201, "other", "the"), (202, None, "the"), (203, "x", None), (204, "The Big Red", "like the sea dog"), (205, "sea-dog", "neither big nor: the (big) RED"), (206, "sea dog", "the red")]
    split = lambda t: [w for w in re.split("[^a-z0-9_]+", (t or "").lower()) if w]
    holds = lambda gloss, label: bool(split(label)) and f" {' '.join(split(label))} " in f" {' '.join(split(gloss))} "
    want = {(a[0], b[0]) for a in rows_ for b in rows_ if a[0] < b[0] and holds(a[2], b[1]) and holds(b[2], a[1])}
    frame = spark.createDataFrame(rows_, "id int, label string, gloss string")
    assert rows(match.mutual_names(frame)) == want and (204, 205) in want and (200, 201) in want and len(want) > 20
    same = spark.createDataFrame([(3, "x", "g"), (1, "y", "g"), (2, "z", None), (4, "z", None), (7, "q", "g"), (9, "q", "h")], "id int, label string, gloss string")
    assert rows(match.equal_glosses(same)) == {(1, 1, 3), (3, 1, 3), (7, 1, 3)}
    assert rows(match.mirror_pairs(same)) == {(1, 3, "equal"), (1, 7, "equal")}


def test_copies_that_name_each_other(spark):
    """Copies stand for each other: the rows of mirror_pairs, spread over the copies, are all pairs that name each other."""
    kinds = [("the", "The order F"), ("the", "the order, O"), ("The", "the order f!"), ("k1", "the k2"), ("k2", "of K1"), ("x", "y"), ("y", "the x"), ("z", "the z z"), ("-", "the"), ("", "k1"), ("q", None)]
    glosses = [(i - 20, *kinds[i % len(kinds)]) for i in range(40)] + [(90, "z", "z"), (91, "a b", "not a b"), (92, "a", "b not a b"), (93, "b not a", "a b")]
    frame = spark.createDataFrame(glosses, "id int, label string, gloss string")
    got = rows(match.mirror_pairs(frame))
    stands = {b: a for a, b, kind in got if kind in ("copy", "mutual_copy")}
    of = {}
    for i, _, _ in glosses:
        of.setdefault(stands.get(i, i), set()).add(i)
    spread = {(min(x, y), max(x, y)) for a, b, kind in got if kind == "mutual" for x in of[a] for y in of[b]}
    spread |= {(x, y) for a in {a for a, _, kind in got if kind == "mutual_copy"} for x in of[a] for y in of[a] if x < y}
    assert spread == rows(match.mutual_names(frame)) and len(spread) > 100
    assert not {a for a, _, kind in got if kind == "mutual"} & set(stands) and len([r for r in got if r[2] == "mutual"]) < 12
    assert {kind for _, _, kind in got} == {"mutual", "mutual_copy", "copy", "equal"}


def test_common_labels_are_paired(spark, sf_dir):
    """Rows whose label is the commonest word name each other too."""
    from crosslink.plans import QUERIES

    got = QUERIES["mirror_pairs"](spark, sf_dir).filter("a < 0 and kind <> 'equal'").groupBy("kind").count().collect()
    assert {r.kind: r["count"] > 0 for r in got} == {"mutual": True, "mutual_copy": True}


def test_a_key_with_most_rows_is_in_many_ranges(spark):
    rnd = __import__("random").Random(9)
    events = [("hot" if rnd.random() < 0.9 else rnd.choice(["a", "b", None]), rnd.randrange(300), rnd.choice("xy"), i) for i in range(1500)] + [("single", 1, "x", -1)]
    frame = spark.createDataFrame(events, "k string, t int, label string, tie int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt = windows.with_borders(frame, ["k"], ["t", "tie"])
        assert dealt.filter("k = 'hot' and own").select("range").distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
        got = {f: sorted(map(tuple, df.collect()), key=repr) for f, df in (("intervals", windows.intervals(frame, ["k"], "t", "label", ["tie"])), ("repeated", windows.alternation_violations(frame, ["k"], "t", "label", ["tie"])), ("gaps", windows.max_gap(frame, ["k"], "t")))}
        spans = [("hot" if rnd.random() < 0.9 else "a", 10 * i, 10 * i + rnd.choice([4, 9]), f"p{i}") for i in range(60)]
        asked = [(rnd.choice(["hot", "hot", "hot", "a", None]), s, s + rnd.choice([1, 3]), i) for i, s in enumerate(rnd.randrange(-5, 620) for _ in range(800))]
        held = windows.windows_in_intervals(spark.createDataFrame(asked, "k string, start int, end int, n int"), spark.createDataFrame(spans, "k string, start int, end int, label string"), ["k"], 1.0)
        assert {(r.n, r.reference) for r in held.collect()} == {(n, next((p for q, a, b, p in spans if q == k and a + 1 <= s and e <= b - 1), None)) for k, s, e, n in asked}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    by = {}
    for k, t, label, tie in events:
        by.setdefault(k, []).append((t, tie, label))
    pairs = [(k, a[0], b[0], a[2], b[2]) for k, v in by.items() for a, b in zip(sorted(v), sorted(v)[1:])]
    assert got["intervals"] == sorted(pairs, key=repr)
    assert got["repeated"] == sorted([(k, e, s, "REPEATED") for k, _, e, f, s in pairs if f == s] + [(k, None, None, "TOO_FEW") for k, v in by.items() if len(v) < 2], key=repr)
    gaps = {k: sorted({t for t, *_ in v}) for k, v in by.items()}
    assert got["gaps"] == sorted([(k, max((b - a for a, b in zip(v, v[1:])), default=None)) for k, v in gaps.items()], key=repr)


def test_identity_of_all_modules_and_attribution(spark):
    frame = spark.createDataFrame
    declared = frame([("a", "s", 3), ("b", "s", 3), ("c", "s", 3), ("d", "s", 3)], "path string, sha256 string, byte_count int")
    observed = frame([("a", "s", 3), ("b", "t", 3), ("c", "s", 4), ("x", "s", 1)], "path string, sha256 string, length long")
    assert rows(rules.module_identity(declared, observed)) == {("b", "MODULE_IDENTITY_CHANGED"), ("c", "MODULE_IDENTITY_CHANGED"), ("d", "MODULE_UNREADABLE")}
    notice = ";; IEEE hereby grants Licensee  \n;; to prepare derivative works\t\n;; if appropriately acknowledged\n"
    modules = frame([("m", "; head\r\n" + notice + "(a b)"), ("short", "; head\n"), ("other", "x\n" + notice.replace("derivative", "any"))], "path string, text string")
    approved = frame([(p, "f00", "Thanks.", 2, 4) for p in ("m", "short", "other", "gone")], "path string, sha256 string, acknowledgement string, first_line int, last_line int")
    got = {r.path: r for r in rules.attributions(modules, approved, "c0ffee").collect()}
    assert {p: r.code for p, r in got.items()} == {"m": None, "short": "NOTICE_RANGE", "other": "GRANT_MISSING", "gone": "MODULE_ABSENT"}
    kept = "\n".join(x.rstrip() for x in notice.split("\n"))
    assert got["m"].attribution.endswith("Exact source license notice:\n" + kept) and "Source module: m (f00)\nAcknowledgement: Thanks.\n" in got["m"].attribution
    assert got["m"].notice_sha256 == __import__("hashlib").sha256(kept.encode()).hexdigest() and got["other"].attribution is None


def test_closure_of_random_graphs(spark):
    """Chains, cycles and branches of random edges, against a walk from each node; a closure that is added to has the same pairs."""
    import random

    for seed in (1, 2):
        r = random.Random(seed)
        pairs = sorted({(r.randrange(40), r.randrange(40)) for _ in range(45)} | {(n, n + 1) for n in range(100, 113)})
        up, want = {}, set()
        for a, b in pairs:
            up.setdefault(a, []).append(b)
        for a in up:
            front = list(up[a])
            while front:
                b = front.pop()
                if (a, b) not in want:
                    want.add((a, b))
                    front += up.get(b, [])
        edges = lambda some: spark.createDataFrame(some, "child int, parent int")
        got = [tuple(x) for x in graph.ancestor_closure(edges(pairs), reflexive=False).collect()]
        assert len(got) == len(set(got)) and set(got) == want
        old = graph.ancestor_closure(edges(pairs[::2]), reflexive=False)
        added = [tuple(x) for x in graph.closure_delta(old, edges(pairs[1::2]), reflexive=False).collect()]
        assert {tuple(x) for x in old.collect()} | set(added) == want


def test_resolve_profile(spark, tmp_path):
    """Repeats give one row, their smallest grounded role; local roles that a compact file unfolds to are neither sent whole to tasks nor gathered before they are dealt."""
    path = str(tmp_path / "schemas")
    spark.range(2000).withColumnRenamed("id", "schema_id").write.parquet(path)
    schemas = spark.read.parquet(path)
    roles = F.array(*[F.struct(F.lit(a).alias("local_role"), F.lit(b).cast("string").alias("grounded_role")) for a, b in (("a", "z"), ("a", None), ("a", "x"), ("b", None), ("c", "y"))])
    local = schemas.select("schema_id", F.explode(roles).alias("r")).select("schema_id", "r.*")
    asked = F.array(*[F.struct(F.lit(a).alias("local_role"), F.lit(b).alias("expected_role")) for a, b in (("a", "x"), ("b", "x"), ("c", "x"), ("d", "x"))])
    profile = schemas.select("schema_id", F.lit("r").alias("consumer_role"), F.explode(asked).alias("r")).select("schema_id", "consumer_role", "r.*")
    out = match.resolve_profile(profile, local)
    got = {tuple(r) for r in out.groupBy("local_role", "grounded_role", "status").count().collect()}
    assert got == {("a", "x", "resolved", 2000), ("b", None, "ungrounded", 2000), ("c", "y", "mismatch", 2000), ("d", None, "unknown_local_role", 2000)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Aggregate" not in plan
