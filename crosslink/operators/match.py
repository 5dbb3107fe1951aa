"""Joins that reconcile identifiers, roles and versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from crosslink.functions.ids import argument_number, stable_id, strip_argument
from crosslink.scratch import written


def match_identifiers(donors: DataFrame, sources: DataFrame, available: DataFrame | None = None) -> DataFrame:
    """``donors`` (family, donor_id, normal_id) with status: matched, missing, invalid or source_unavailable.

    ``sources``: family, source_id. ``available``: families whose source could be read; without it all are.
    """
    known = sources.select("family", F.col("source_id").alias("normal_id"), F.lit(True).alias("__known")).distinct()
    out = donors.join(known, ["family", "normal_id"], "left")
    there = F.lit(True)
    if available is not None:
        out = out.join(available.select("family").distinct().withColumn("__there", F.lit(True)), "family", "left")
        there = F.coalesce("__there", F.lit(False))
    status = F.when(~there, "source_unavailable").when(F.col("normal_id").isNull(), "invalid").when(F.col("__known"), "matched").otherwise("missing")
    return out.select(*donors.columns, status.alias("status"))


def crosswalk(mappings: DataFrame, comparisons: DataFrame, argument_source: str = "propbank") -> DataFrame:
    """``mappings`` with record_id, identity_state, state and review_status.

    mappings: canonical_id, canonical_kind, source_key, source_id, relation, producer_method, producer_confidence,
    producer_method_scope, evidence_ref; all are carried on. The record's id is made of canonical_id, source_key, source_id,
    relation and evidence_ref, so the same mapping on other evidence is another record. ``comparisons``: family, donor_id, status. A
    last ``:`` segment is dropped from ids of ``argument_source`` before the join. Unmatched and unavailable rows are
    not_applicable; only candidate alignments are candidates.
    """
    states = comparisons.select(F.col("family").alias("source_key"), F.col("donor_id").alias("__id"), F.col("status").alias("__status")).dropDuplicates(["source_key", "__id"])
    keyed = mappings.withColumn("__id", strip_argument(F.col("source_id"), F.col("source_key"), argument_source))
    identity = F.when(F.col("__status") == "matched", "exact").when(F.col("__status").isin("missing", "invalid"), F.col("__status")).otherwise("not_applicable")
    record = stable_id("lcx1_", *[F.col(c) for c in ("canonical_id", "source_key", "source_id", "relation", "evidence_ref")])
    state = F.when(F.col("relation") == "candidate_alignment", "candidate").otherwise("unresolved")
    out = keyed.join(states, ["source_key", "__id"], "left")
    return out.select(*mappings.columns, record.alias("record_id"), identity.alias("identity_state"), state.alias("state"), F.lit("not_reviewed").alias("review_status"))


def resolve_endpoints(relations: DataFrame, nodes: DataFrame) -> DataFrame:
    """relation_id, end, status: ends whose node is missing or bears another name. relations: relation_id, sub_id, sub_name, super_id, super_name."""
    ends = relations.select("relation_id", F.explode(F.array(*[F.struct(F.lit(e).alias("end"), F.col(f"{e}_id").alias("id"), F.col(f"{e}_name").alias("name")) for e in ("sub", "super")])).alias("x"))
    joined = ends.select("relation_id", "x.*").join(nodes.select("id", F.col("name").alias("real")).dropDuplicates(["id"]).withColumn("__there", F.lit(True)), "id", "left")
    status = F.when(F.col("__there").isNull(), "missing").when(~F.col("name").eqNullSafe(F.col("real")), "name_mismatch")
    return joined.select("relation_id", "end", status.alias("status")).filter("status is not null")


def resolve_element_endpoints(element_relations: DataFrame, relations: DataFrame, elements: DataFrame) -> DataFrame:
    """relation_id, fe_relation_id, end, status: ends of element relations that are no element (missing), or one of another frame than the relation's end (wrong_frame).

    element_relations: relation_id, fe_relation_id, sub_fe_id, super_fe_id; relations: relation_id, sub_id, super_id (frames);
    elements: fe_id, frame_id. An element relation without its relation is missing_relation.
    """
    ends = F.array(*[F.struct(F.lit(e).alias("end"), F.col(f"{e}_fe_id").alias("fe_id"), F.col(f"{e}_id").alias("wanted")) for e in ("sub", "super")])
    known = relations.select("relation_id", "sub_id", "super_id", F.lit(True).alias("__relation")).dropDuplicates(["relation_id"])
    rows = element_relations.join(known, "relation_id", "left").select("relation_id", "fe_relation_id", "__relation", F.explode(ends).alias("x")).select("relation_id", "fe_relation_id", "__relation", "x.*")
    own = elements.select("fe_id", "frame_id").dropDuplicates(["fe_id"])
    status = F.when(F.col("__relation").isNull(), "missing_relation").when(F.col("frame_id").isNull(), "missing").when(~F.col("frame_id").eqNullSafe(F.col("wanted")), "wrong_frame")
    return rows.join(own, "fe_id", "left").select("relation_id", "fe_relation_id", "end", status.alias("status")).filter("status is not null")


def reconcile_index(declared: DataFrame, observed: DataFrame, key: str, content: str) -> DataFrame:
    """key, status: missing (declared only), extra (observed only), drift (other content) or ok."""
    a, b = declared.select(key, F.col(content).alias("__a"), F.lit(1).alias("__d")), observed.select(key, F.col(content).alias("__b"), F.lit(1).alias("__o"))
    status = F.when(F.col("__o").isNull(), "missing").when(F.col("__d").isNull(), "extra").when(~F.col("__a").eqNullSafe(F.col("__b")), "drift").otherwise("ok")
    return a.join(b, key, "full_outer").select(key, status.alias("status"))


def exclude_existing(new: DataFrame, owned: DataFrame, keys: list[str]) -> DataFrame:
    return new.join(owned.select(*keys).distinct(), keys, "left_anti")


def induced_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """child, parent: distinct edges with both ends in ``nodes`` (id)."""
    ids = nodes.select("id").distinct()
    both = edges.join(ids, edges.child == ids.id, "left_semi")
    return both.join(ids, both.parent == ids.id, "left_semi").select("child", "parent").distinct()


def role_correspondences(relations: DataFrame, roles: DataFrame, collapsing: list[str], divergent: DataFrame | None = None) -> DataFrame:
    """from_id, to_id, relation, arg, from_role, to_role, status for each argument that both predicates of a collapsing relation have.

    relations: from_id, relation, to_id. roles: predicate_id, arg, role, ord; of several roles at one place the last by ord
    holds. divergent: from_id, to_id, arg whose roles don't correspond; these rows come out as skipped, so that nothing is lost.
    """
    place = roles.groupBy("predicate_id", "arg").agg(F.max_by("role", F.struct("ord", "role")).alias("role"))
    side = lambda s: place.select(F.col("predicate_id").alias(f"{s}_id"), "arg", F.col("role").alias(f"{s}_role"))
    out = relations.filter(F.col("relation").isin(*collapsing)).join(side("from"), "from_id").join(side("to"), ["to_id", "arg"])
    if divergent is not None:
        out = out.join(divergent.select("from_id", "to_id", "arg", F.lit(True).alias("__off")).distinct(), ["from_id", "to_id", "arg"], "left")
    status = F.when(F.col("__off"), "skipped_divergent").otherwise("aligned") if divergent is not None else F.lit("aligned")
    return out.select("from_id", "to_id", "relation", "arg", "from_role", "to_role", status.alias("status"))


def pairs_within(df: DataFrame, group: str, item: str, payload: list[str] | None = None) -> DataFrame:
    """group, item_a, item_b (a < b) of the items of a group, which are few by nature, as the arguments of a predicate."""
    side = lambda s: df.select(F.col(group), *[F.col(c).alias(f"{c}_{s}") for c in [item, *(payload or [])]]).distinct()
    return side("a").join(side("b"), group).filter(F.col(f"{item}_a") < F.col(f"{item}_b"))


def resolve_pairs(pairs: DataFrame, roles: DataFrame) -> DataFrame:
    """``pairs`` (predicate_id, arg_a, arg_b) with role_a, role_b and status: resolved or the side without a role. roles: predicate_id, arg, role."""
    side = lambda s: roles.select("predicate_id", F.col("arg").alias(f"arg_{s}"), F.col("role").alias(f"role_{s}")).dropDuplicates(["predicate_id", f"arg_{s}"])
    out = pairs.join(side("a"), ["predicate_id", "arg_a"], "left").join(side("b"), ["predicate_id", "arg_b"], "left")
    status = F.when(F.col("role_a").isNull() & F.col("role_b").isNull(), "both_unresolved").when(F.col("role_a").isNull(), "first_unresolved").when(F.col("role_b").isNull(), "second_unresolved").otherwise("resolved")
    return out.select(*pairs.columns, "role_a", "role_b", status.alias("status"))


def review_rows(crosswalk: DataFrame, reviewed: DataFrame, texts: DataFrame, tied: DataFrame, n: int) -> DataFrame:
    """The ``n`` first candidates that nobody has reviewed, tied ones first, then by record_id, with both evidence texts."""
    out = crosswalk.filter("state = 'candidate'").join(reviewed.select("record_id").distinct(), "record_id", "left_anti")
    text = lambda c: texts.select(F.col("id").alias(c), F.col("text").alias(f"{c}_text")).dropDuplicates([c])
    out = out.join(text("canonical_id"), "canonical_id").join(text("source_id"), "source_id")
    out = out.join(tied.select("canonical_id", F.lit(True).alias("__tied")).distinct(), "canonical_id", "left")
    flagged = out.select("record_id", "canonical_id", "source_id", "canonical_id_text", "source_id_text", F.coalesce("__tied", F.lit(False)).alias("tied"))
    return flagged.orderBy(F.desc("tied"), "record_id").limit(n)


def bind_reviews(reviews: DataFrame, slots: DataFrame, roles: DataFrame) -> DataFrame:
    """``reviews`` (case_id, predicate_id, label) with role_id and status: bound, missing_slot or missing_role."""
    a = slots.select("predicate_id", "label", F.lit(True).alias("__slot")).distinct()
    out = reviews.join(a, ["predicate_id", "label"], "left").join(roles.select("label", "role_id").dropDuplicates(["label"]), "label", "left")
    status = F.when(F.col("__slot").isNull(), "missing_slot").when(F.col("role_id").isNull(), "missing_role").otherwise("bound")
    return out.select(*reviews.columns, F.when(status == "bound", F.col("role_id")).alias("role_id"), status.alias("status"))


def argument_evidence(slots: DataFrame, arguments: DataFrame) -> DataFrame:
    """``slots`` (id, role) with arg, description and status by the number of arguments: exact, not_supplied, conflicting.

    arguments: id, number, description, ord. Roles like ARG07 stand for argument 7; others have no argument.
    """
    hits = arguments.groupBy("id", F.col("number").cast("string").alias("arg")).agg(F.count("*").alias("__n"), F.min_by("description", F.struct("ord", "description")).alias("description"))
    keyed = slots.withColumn("arg", argument_number(F.col("role")))
    status = F.when(F.coalesce("__n", F.lit(0)) == 0, "not_supplied").when(F.col("__n") == 1, "exact").otherwise("conflicting")
    return keyed.join(hits, ["id", "arg"], "left").select(*slots.columns, "arg", F.when(F.col("__n") == 1, F.col("description")).alias("description"), status.alias("status"))


def inspect_predicates(predicates: DataFrame, roles: DataFrame, mappings: DataFrame) -> DataFrame:
    """predicate_id, label, roles (in order), mappings (map of family to sorted ids), one row for each predicate."""
    r = roles.groupBy("predicate_id").agg(F.array_sort(F.collect_list(F.struct("ord", "role", "required"))).alias("roles"))
    m = mappings.groupBy("predicate_id", "family").agg(F.array_sort(F.collect_set("source_id")).alias("ids"))
    m = m.groupBy("predicate_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("family", "ids")))).alias("mappings"))
    return predicates.select("predicate_id", "label").join(r, "predicate_id", "left").join(m, "predicate_id", "left")


def inspect_lineage(mappings: DataFrame, sources: DataFrame, canonical_id: str | None = None, source_id: str | None = None) -> DataFrame:
    """Mappings of one canonical or source id with their source's description; status undeclared_source where it has none."""
    out = mappings
    for name, value in (("canonical_id", canonical_id), ("source_id", source_id)):
        out = out if value is None else out.filter(F.col(name) == value)
    out = out.join(sources.select("source_key", F.col("description").alias("source_description"), F.lit(True).alias("__there")), "source_key", "left")
    return out.select(*mappings.columns, "source_description", F.when(F.col("__there"), "declared").otherwise("undeclared_source").alias("status"))


def compare_runs(base: DataFrame, other: DataFrame, keys: list[str], value: str, prediction: str) -> DataFrame:
    """keys, drift, flipped for rows that both runs have."""
    b = other.select(*keys, F.col(value).alias("__v"), F.col(prediction).alias("__p"))
    return base.join(b, keys).select(*keys, F.abs(F.col(value) - F.col("__v")).alias("drift"), (~F.col(prediction).eqNullSafe(F.col("__p"))).alias("flipped"))


def unordered_relations(pairs: DataFrame, relations: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``pairs`` with the relation between two ids, whichever way it was stated; of several the last by ord. relations: a, b, relation, ord."""
    low, high = lambda x, y: F.least(F.col(x), F.col(y)), lambda x, y: F.greatest(F.col(x), F.col(y))
    last = relations.select(low("a", "b").alias("__low"), high("a", "b").alias("__high"), "relation", "ord").groupBy("__low", "__high").agg(F.max_by("relation", F.struct("ord", "relation")).alias("relation"))
    keyed = pairs.withColumns({"__low": low(a, b), "__high": high(a, b)})
    return keyed.join(last, ["__low", "__high"], "left").select(*pairs.columns, "relation")


def any_pairing(rows: DataFrame, relations: DataFrame, collapsing: list[str]) -> DataFrame:
    """id, linked: some x of a row's list ``xs`` and another y of ``ys`` stand in a collapsing relation. The lists are short."""
    ids = rows.select("id").distinct()
    pairs = rows.select("id", F.explode("xs").alias("a"), "ys").select("id", "a", F.explode("ys").alias("b")).filter("a <> b")
    hit = unordered_relations(pairs, relations).filter(F.col("relation").isin(*collapsing)).select("id").distinct().withColumn("__hit", F.lit(True))
    return ids.join(hit, "id", "left").select("id", F.coalesce("__hit", F.lit(False)).alias("linked"))


def coverage_matrix(rows: DataFrame, columns: DataFrame, rules: DataFrame) -> DataFrame:
    """construction, domain, status: the rule of a cell, else its construction's default (rule without a domain), else undeclared.

    Both axes are small lists; the cells are the result itself.
    """
    cells = rows.select("construction").distinct().crossJoin(F.broadcast(columns.select("domain").distinct()))
    own = rules.filter("domain is not null").select("construction", "domain", F.col("status").alias("__own"))
    default = rules.filter("domain is null").select("construction", F.col("status").alias("__default"))
    out = cells.join(own, ["construction", "domain"], "left").join(default, "construction", "left")
    return out.select("construction", "domain", F.coalesce("__own", "__default", F.lit("undeclared")).alias("status"), F.when(F.col("__own").isNotNull(), "override").otherwise("default").alias("rule"))


def pair_files(files: DataFrame, extensions: list[str]) -> DataFrame:
    """stem, found, status: complete if each extension stands exactly once; files: stem, ext."""
    found = files.groupBy("stem").agg(F.array_sort(F.collect_list("ext")).alias("found"))
    want = F.array(*[F.lit(e) for e in sorted(extensions)])
    status = F.when(F.col("found") == want, "complete").when(F.size(F.array_except(want, F.col("found"))) > 0, "missing").otherwise("unexpected")
    return found.select("stem", F.array_join("found", ",").alias("found"), status.alias("status"))


def participant_counts(files: DataFrame, expected: DataFrame) -> DataFrame:
    """participant, ext, n, status: files of each participant and type; a participant that is expected and has none is missing, one that isn't is unexpected. files: participant, ext; expected: participant."""
    n = files.groupBy("participant", "ext").agg(F.count("*").alias("n"))
    wanted = expected.select("participant", F.lit(True).alias("__wanted")).distinct()
    status = F.when(F.col("ext").isNull(), "missing").when(F.col("__wanted").isNull(), "unexpected").otherwise("expected")
    return n.join(wanted, "participant", "full_outer").select("participant", "ext", F.coalesce("n", F.lit(0)).alias("n"), status.alias("status"))


def words_of(text: Column) -> Column:
    """Lower-cased words of a text, joined by one space: runs of a to z, digits and underscores."""
    return F.trim(F.regexp_replace(F.lower(text), "[^a-z0-9_]+", " "))


def mutual_names(glosses: DataFrame) -> DataFrame:
    """a, b (a < b) whose labels stand in each other's glosses, as words in a row. glosses: id, label, gloss.

    A label is looked up by the word of it that the fewest glosses hold, and then verified in place. Of a pair that name each other
    it is enough to find one side, so a gloss is only searched for labels whose rarest word is no more frequent than its own
    label's: the list of a common word shrinks to the glosses whose own labels are as common. Words are counted in the tasks that
    read them. Labels or glosses without words name nothing.
    """
    return mutual_words(worded(glosses))


def worded(glosses: DataFrame) -> DataFrame:
    """id, name, said: the words of labels and glosses that have any."""
    some = lambda c: F.lower(c).rlike("[a-z0-9_]")
    return glosses.filter(F.col("id").isNotNull() & some("label") & some("gloss")).select("id", words_of(F.col("label")).alias("name"), words_of(F.col("gloss")).alias("said"))


def mutual_words(own: DataFrame) -> DataFrame:
    """``mutual_names`` of words: id, name, said."""
    own = own.select("id", F.split("name", " ").alias("name"), F.split("said", " ").alias("said"))
    held = own.select("id", F.explode(F.array_distinct("said")).alias("word"))
    asked = own.select("id", F.explode(F.array_distinct("name")).alias("word"))
    df = held.groupBy("word").agg(F.count("*").alias("df"))
    keys = asked.join(df, "word").groupBy("id").agg(F.count("*").alias("found"), F.min(F.struct("df", "word")).alias("key"))
    keys = written(own.join(keys, "id").filter("found = size(array_distinct(name))").select("id", "name", "said", "key.df", "key.word"), "keys")  # read four times
    rare = keys.select(F.col("id").alias("a"), F.col("df").alias("most"), F.explode(F.array_distinct("said")).alias("word"))
    found = rare.join(keys.select(F.col("id").alias("b"), "df", "word"), "word").filter("df <= most and a <> b").select("a", "b").distinct()
    line = lambda c: F.concat(F.lit(" "), F.array_join(c, " "), F.lit(" "))
    side = lambda x: keys.select(F.col("id").alias(x), line("said").alias(f"said_{x}"), line("name").alias(f"name_{x}"))
    both = found.join(side("a"), "a").join(side("b"), "b").filter(F.contains("said_a", F.col("name_b")) & F.contains("said_b", F.col("name_a")))
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def equal_glosses(glosses: DataFrame) -> DataFrame:
    """id, group_id (the least id with the same gloss), size: the rows whose gloss another row has too. A gloss is counted before it is shuffled."""
    keyed = glosses.filter("gloss is not null and id is not null").select("id", F.sha2("gloss", 256).alias("gloss"))
    groups = keyed.groupBy("gloss").agg(F.min("id").alias("group_id"), F.count("*").alias("size")).filter("size > 1")
    return keyed.join(groups, "gloss").select("id", "group_id", "size")


def mirror_pairs(glosses: DataFrame) -> DataFrame:
    """a, b, kind: rows that name each other in their glosses, and each row with the first one of the same gloss (equal). glosses: id (unique), label, gloss.

    Rows with the same words in label and gloss are copies, and the least id stands for them: mutual are pairs (a < b) of rows that
    stand for their copies, and hold for all of these; each other copy b comes with its a, as mutual_copy if the copies name each other, else
    as copy. So no pair is lost, and many copies of a label that stands in its own gloss don't come as all their pairs.
    """
    own, same = written(worded(glosses), "words"), F.sha2(F.concat("name", F.lit("/"), "said"), 256).alias("same")
    first = written(own.groupBy("name", "said").agg(F.min("id").alias("id"), F.max("id").alias("last")), "copies")  # read four times
    mutual = mutual_words(first).select("a", "b", F.lit("mutual").alias("kind"))
    around = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    kind = F.when(F.contains(around("said"), around("name")), "mutual_copy").otherwise("copy")
    several = first.filter("id <> last").select(F.col("id").alias("a"), kind.alias("kind"), same)
    copies = own.select(F.col("id").alias("b"), same).hint("merge").join(several, "same").filter("a <> b").select("a", "b", "kind")
    equal = equal_glosses(glosses).filter("id <> group_id").select(F.col("group_id").alias("a"), F.col("id").alias("b"), F.lit("equal").alias("kind"))
    return mutual.unionByName(copies).unionByName(equal)


def positional_roles(mappings: DataFrame) -> DataFrame:
    """predicate_id, arg, role from ids like ``sense:ARGn``; of several mappings of a place the last by ord. mappings: source_id, role, ord."""
    split = mappings.select(F.regexp_extract("source_id", r"^(.*):ARG([0-9]+)$", 1).alias("predicate_id"), F.regexp_extract("source_id", r"^(.*):ARG([0-9]+)$", 2).alias("arg"), "role", "ord")
    return split.filter("arg <> ''").groupBy("predicate_id", F.col("arg").cast("int").alias("arg")).agg(F.max_by("role", F.struct("ord", "role")).alias("role"))


def resolve_profile(profile: DataFrame, locals_: DataFrame) -> DataFrame:
    """``profile`` (schema_id, consumer_role, local_role, expected_role) with grounded_role and status.

    Of repeats of a local role the smallest grounded_role counts, none last. They are dealt by key before they are looked at: a task
    that reads a compact file would else hold a key for each local role that the file unfolds to. For the same reason their size is
    guessed too small, so no side is sent whole to the tasks; one sort serves repeats and join.
    """
    keys = ["schema_id", "local_role"]
    at = F.row_number().over(W.partitionBy(*keys).orderBy(F.col("grounded_role").asc_nulls_last()))
    known = locals_.select(*keys, "grounded_role").repartition(*keys).withColumn("__at", at).filter("__at = 1").select(*keys, "grounded_role", F.lit(True).alias("__there"))
    out = profile.join(known.hint("merge"), keys, "left")
    status = F.when(F.col("__there").isNull(), "unknown_local_role").when(F.col("grounded_role").isNull(), "ungrounded").when(~F.col("grounded_role").eqNullSafe(F.col("expected_role")), "mismatch").otherwise("resolved")
    return out.select(*profile.columns, "grounded_role", status.alias("status"))


def transform_evidence(transforms: DataFrame, slots: DataFrame, correspondences: DataFrame) -> DataFrame:
    """``transforms`` (case_id, from_id, from_role, to_id, to_role) with status: the first thing that is missing, or bound."""
    side = lambda s: slots.select(F.col("predicate_id").alias(f"{s}_id"), F.col("role").alias(f"{s}_role"), F.lit(True).alias(f"__{s}")).distinct()
    keys = ["from_id", "from_role", "to_id", "to_role"]
    out = transforms.join(side("from"), ["from_id", "from_role"], "left").join(side("to"), ["to_id", "to_role"], "left").join(correspondences.select(*keys, F.lit(True).alias("__c")).distinct(), keys, "left")
    status = F.when(F.col("__from").isNull(), "missing_source_role").when(F.col("__to").isNull(), "missing_target_role").when(F.col("__c").isNull(), "missing_correspondence").otherwise("bound")
    return out.select(*transforms.columns, status.alias("status"))


def needed_files(records: DataFrame, needed: DataFrame) -> DataFrame:
    """path: the files that hold an id that is needed."""
    return records.join(needed.select("id").distinct(), "id", "left_semi").select("path").distinct()


def audit_roles(slots: DataFrame, relations: DataFrame, types: DataFrame, constraints: DataFrame, closure: DataFrame) -> DataFrame:
    """``slots`` (predicate, label, role, type) with role_status, type_status and constraint_status.

    relations: relation, is_case_role. types: type. constraints: relation, required_type (the wanted kind, place and module only).
    closure: node, ancestor, reflexive. Direct match needs exactly one required type, equal to the slot's; a subtype lies below all
    of them, a supertype above all. Constraints apply only to exact case roles with an exact type.
    """
    from crosslink.operators.graph import type_relation

    r = relations.select(F.col("relation").alias("role"), F.col("is_case_role").alias("__case")).dropDuplicates(["role"])
    t = types.select("type", F.lit(True).alias("__type")).distinct()
    out = slots.join(r, "role", "left").join(t, "type", "left")
    role = F.when(F.col("role").isNull(), "unmapped").when(F.col("__case").isNull(), "missing_current_source").when(F.col("__case"), "exact_case_role").otherwise("exact_non_case_relation")
    kind = F.when(F.col("type").isNull(), "unmapped").when(F.col("__type").isNull(), "missing_current_source").otherwise("exact_current_source")
    out = out.select(*slots.columns, role.alias("role_status"), kind.alias("type_status"))
    needed = type_relation(out.filter("role_status = 'exact_case_role' and type_status = 'exact_current_source'").select("role", "type").distinct(), constraints.select(F.col("relation").alias("role"), "required_type"), closure)
    out = out.join(needed, ["role", "type"], "left")
    applies = (F.col("role_status") == "exact_case_role") & (F.col("type_status") == "exact_current_source")
    return out.select(*slots.columns, "role_status", "type_status", F.when(applies, F.col("relation_status")).otherwise("not_applicable").alias("constraint_status"))


def eligible_view(crosswalk: DataFrame) -> DataFrame:
    """Rows that a runtime view may use: verified ones only."""
    return crosswalk.filter("state = 'verified'")


def view_receipt(crosswalk: DataFrame) -> DataFrame:
    """source_key, rows, eligible, withheld; the last two add up to the first."""
    n = lambda c: F.count_if(c).cast("long")
    ok = F.coalesce(F.col("state") == "verified", F.lit(False))
    return crosswalk.groupBy("source_key").agg(F.count("*").alias("rows"), n(ok).alias("eligible"), n(~ok).alias("withheld"))
