"""Reviews, mapping requests, assertions, projections and pair decisions."""

from pyspark.sql import functions as F

from crosslink.functions import texts as X
from crosslink.functions import values as V
from crosslink.operators import checks, match, rules
from crosslink.plans.base import query

VERDICT = "CASE WHEN {0} IS NULL THEN 'abstain' WHEN {0} = 1 THEN 'supports' ELSE 'contradicts' END"


def verdict(c):
    return F.when(c.isNull(), "abstain").when(c == 1, "supports").otherwise("contradicts")


@query(f"""WITH v AS (SELECT d.doc_id, {VERDICT.format('quality')} AS a, {VERDICT.format('toxic')} AS b FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT doc_id, CASE WHEN a = 'supports' AND b = 'supports' THEN 'tentatively_verified' WHEN a = 'contradicts' AND b = 'contradicts' THEN 'rejected' ELSE 'unresolved' END AS outcome
  FROM v""")
def two_pass(t):
    return t.documents.join(t.labels, "doc_id", "left").select("doc_id", rules.two_pass(verdict(F.col("quality")), verdict(F.col("toxic"))).alias("outcome"))


@query("""SELECT 'q:' || doc_id || ':' || lang AS case_id, doc_id AS predicate_id, lang AS label, coalesce(text, '') AS head FROM documents WHERE lang <> 'en'""")
def review_queue(t):
    d = t.documents
    queue = rules.review_queue(d.select(F.col("doc_id").alias("predicate_id"), F.col("lang").alias("label"), F.when(F.col("lang") == "en", "mapped").otherwise("unmapped").alias("status")), "status", "unmapped", "q", d.select(F.col("doc_id").alias("predicate_id"), F.lit("head").alias("field"), "text"))
    return queue.select("case_id", "predicate_id", "label", F.coalesce(F.try_element_at("evidence", F.lit("head")), F.lit("")).alias("head"))


@query("""WITH q AS (SELECT doc_id AS c, doc_id % 6 AS k FROM documents), b AS (SELECT c,
  CASE WHEN k = 0 THEN 'no_proposal' WHEN k = 1 THEN 'source_evidence_unavailable' WHEN k = 2 THEN 'quote_not_grounded' WHEN quality IS NULL THEN 'not_reviewed' ELSE 'reviewed' END AS basis, quality
  FROM q LEFT JOIN labels ON doc_id = c)
SELECT c AS case_id, CASE WHEN basis = 'reviewed' THEN CASE WHEN quality = 1 THEN 'verified' ELSE 'rejected' END ELSE 'unresolved' END AS state, basis FROM b""")
def governed_states(t):
    k = F.col("doc_id") % 6
    q = t.documents.select(F.col("doc_id").alias("case_id"))
    p = t.documents.filter(k != 0).select(F.col("doc_id").alias("case_id"), F.when(k == 1, "withheld").otherwise("proposed").alias("disposition"), F.when(k == 2, "ambiguous").otherwise("grounded").alias("quote_status"))
    d = t.labels.select(F.col("doc_id").alias("case_id"), F.when(F.col("quality") == 1, "verified").otherwise("rejected").alias("decision"))
    return rules.governed_states(q, p, d)


@query("""WITH x AS (SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS record_id, 'c' || o_custkey AS canonical_id, 'candidate' AS state
  FROM orders), r AS (SELECT record_id, CASE WHEN o % 2 = 0 THEN 'verified' ELSE 'rejected' END AS outcome
  FROM (SELECT sha256(CAST(o_orderkey AS VARCHAR)) AS record_id, o_orderkey AS o FROM orders WHERE o_orderkey % 7 = 0))
SELECT record_id, canonical_id, state, CAST(NULL AS VARCHAR) AS reviews_record_id FROM x
  UNION ALL SELECT 'lcr1_' || substr(sha256(concat_ws(chr(0), record_id, outcome)), 1, 24), canonical_id, outcome, record_id FROM x
  JOIN r USING (record_id)""")
def append_reviews(t):
    k = F.col("o_orderkey")
    sha = F.sha2(k.cast("string"), 256).alias("record_id")
    x = t.orders.select(sha, F.concat(F.lit("c"), "o_custkey").alias("canonical_id"), F.lit("candidate").alias("state"))
    return rules.append_reviews(x, t.orders.filter(k % 7 == 0).select(sha, F.when(k % 2 == 0, "verified").otherwise("rejected").alias("outcome")))


@query("""WITH x AS (SELECT o_orderkey AS record_id, o_custkey AS canonical_id, o_orderkey % 1000 AS source_id FROM orders
  WHERE o_orderstatus = 'O' AND o_orderkey % 4 <> 0), tx AS (SELECT doc_id AS id, text FROM documents), ti AS (SELECT DISTINCT c_custkey FROM customer
  WHERE c_acctbal > 9000)
SELECT record_id, canonical_id, source_id, a.text AS canonical_id_text, b.text AS source_id_text, canonical_id IN (SELECT * FROM ti) AS tied FROM x
  JOIN tx a ON a.id = canonical_id JOIN tx b ON b.id = source_id ORDER BY tied DESC, record_id LIMIT 40""")
def select_review_rows(t):
    k = F.col("o_orderkey")
    x = t.orders.select(k.alias("record_id"), F.col("o_custkey").alias("canonical_id"), (k % 1000).alias("source_id"), F.when(F.col("o_orderstatus") == "O", "candidate").otherwise("unresolved").alias("state"))
    texts = t.documents.select(F.col("doc_id").alias("id"), "text")
    return match.review_rows(x, t.orders.filter(k % 4 == 0).select(k.alias("record_id")), texts, t.customer.filter("c_acctbal > 9000").select(F.col("c_custkey").alias("canonical_id")), 40)


# orders as mapping requests between ten predicates
CASES = """cs AS (SELECT o_orderkey AS k, o_custkey % 12 AS f, o_orderkey % 11 AS g, o_custkey AS c, o_orderkey % 19 = 0 AS odd_from, o_orderkey % 23 = 0 AS odd_to FROM orders),
rl AS (SELECT a, b, ['narrowerThan', 'closeMatch', 'related'][(a + b) % 4 + 1] AS relation
  FROM (SELECT unnest(range(10)) AS a), (SELECT unnest(range(10)) AS b) WHERE a < b AND (a + b) % 4 < 3)"""


@query(f"""WITH {CASES}, j AS (SELECT cs.*, CASE WHEN f = g THEN 'identity' ELSE x.relation END AS relation, y.relation AS back, x.a % 3 <> 1 AS known
  FROM cs LEFT JOIN rl x ON x.a = f AND x.b = g LEFT JOIN rl y ON y.a = g AND y.b = f),
e AS (SELECT k, relation, CASE WHEN f >= 10 THEN 'UNKNOWN_PREDICATE' WHEN odd_from THEN 'UNDECLARED_PREDICATE_ROLE' WHEN g >= 10 THEN 'UNKNOWN_PREDICATE' WHEN odd_to THEN 'UNDECLARED_PREDICATE_ROLE'
  WHEN relation IS NULL AND back IS NOT NULL THEN 'MAPPING_DIRECTION_UNSUPPORTED' WHEN relation IS NULL THEN 'PREDICATE_MAPPING_UNSUPPORTED'
  WHEN relation = 'narrowerThan' AND k % 3 = 0 THEN 'NARROWER_PROJECTION_REQUIRES_LOSSY_CONTRACT' WHEN relation = 'narrowerThan' AND k % 2 = 1 THEN 'MAPPING_CONDITION_MISSING' WHEN relation = 'closeMatch' AND k % 5 = 4 THEN 'CLOSE_MATCH_REQUIRES_CONTEXTUAL_REVIEW'
  WHEN relation = 'identity' AND k % 3 <> 0 THEN 'IDENTITY_MAPPING_MUST_BE_LOSSLESS' WHEN relation = 'related' THEN 'RELATION_NOT_EXECUTABLE' WHEN k % 13 = 0 THEN 'DUPLICATE_SOURCE_ROLE_TRANSFORM' WHEN k % 29 = 0 THEN 'ROLE_TRANSFORM_SOURCE_COVERAGE_MISMATCH' WHEN k % 31 = 0 THEN 'ROLE_TRANSFORM_TARGET_COVERAGE_MISMATCH'
  WHEN relation <> 'identity' AND NOT known THEN 'ROLE_TRANSFORM_UNSUPPORTED' WHEN c % 17 = 0 THEN 'ROLE_FILLER_MISMATCH' WHEN c % 7 = 0 AND NOT (k % 4 = 0 AND k % 8 = 0) THEN 'SCOPE_MISMATCH'
  WHEN c % 41 = 0 OR (k % 4 >= 1 AND c % 9 = 0) OR (k % 4 >= 2 AND c % 5 = 0) OR (k % 4 >= 3 AND c % 4 = 0) THEN 'IDENTITY_MISMATCH' END AS code FROM j)
SELECT k AS case_id, CASE WHEN code IS NULL THEN 'allowed' ELSE 'rejected' END AS status, coalesce(code, relation) AS reason FROM e""")
def evaluate_mapping(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pid = lambda x: F.concat(F.lit("p"), x.cast("string"))
    when = lambda test, value, other: F.when(test, F.lit(value)).otherwise(F.lit(other))
    source, target = when(k % 19 == 0, "odd", "agent"), when(k % 23 == 0, "odd", "doer")
    move = F.struct(when(k % 29 == 0, "other", "agent").alias("from_role"), when(k % 31 == 0, "other", "doer").alias("to_role"))
    given = [(k % 2 == 0, "commercial_transaction"), (k % 5 < 4, "contextual_equivalence_reviewed"), (k % 8 == 0, "compare_embedded_proposition")]
    fields = {"proposition_id": 41, "occurrence_id": 9, "assertion_id": 5, "support_record_id": 4}
    cases = t.orders.select(
        k.alias("case_id"),
        pid(c % 12).alias("from_id"),
        pid(k % 11).alias("to_id"),
        F.create_map(source, F.lit("a")).alias("from_roles"),
        F.create_map(target, when(c % 17 == 0, "b", "a")).alias("to_roles"),
        F.when(k % 13 == 0, F.array(move, move)).otherwise(F.array(move)).alias("transforms"),
        F.lit("s").alias("from_scope"),
        when(c % 7 == 0, "t", "s").alias("to_scope"),
        when(k % 3 == 0, "lossless", "lossy").alias("loss"),
        F.array_compact(F.array(*[F.when(test, F.lit(name)) for test, name in given])).alias("conditions"),
        F.element_at(F.array(*[F.lit(x) for x in ("proposition", "occurrence", "assertion", "support")]), (k % 4 + 1).cast("int")).alias("identity_level"),
        F.struct(*[F.lit(1).alias(f) for f in fields]).alias("from_identity"),
        F.struct(*[F.when(c % n == 0, 2).otherwise(1).alias(f) for f, n in fields.items()]).alias("to_identity"),
    )
    ten = t.spark.range(10)
    preds = ten.select(pid(F.col("id")).alias("id"))
    declared = preds.select(F.col("id").alias("predicate_id"), F.explode(F.array(F.lit("agent"), F.lit("doer"))).alias("role"))
    pairs = ten.select(F.col("id").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(9))).alias("b")).filter("a < b")
    m = (F.col("a") + F.col("b")) % 4
    named = F.when(m == 0, "narrowerThan").when(m == 1, "closeMatch").when(m == 2, "related")
    rel = pairs.select("a", pid(F.col("a")).alias("from_id"), named.alias("relation"), pid(F.col("b")).alias("to_id"), F.lit(0).alias("ord")).filter("relation is not null")
    via = F.when(F.col("a") % 3 != 1, F.col("relation")).otherwise(F.lit("another"))
    corr = rel.select("from_id", F.lit("agent").alias("from_role"), "to_id", F.lit("doer").alias("to_role"), via.alias("via_relation"), "ord")
    return rules.evaluate_mappings(cases, preds, declared, rel, corr)


@query(f"""WITH o AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'allowed' ELSE 'rejected' END AS status,
  CASE WHEN quality = 1 THEN 'ALLOWED' ELSE 'SCOPE_MISMATCH:' || toxic END AS reason FROM labels)
SELECT d.doc_id AS case_id, coalesce(status, '') = CASE WHEN d.doc_id % 3 = 0 THEN 'rejected' ELSE 'allowed' END AND (d.doc_id % 3 <> 0 OR starts_with(coalesce(reason, ''), 'SCOPE')) AS passed
  FROM documents d LEFT JOIN o USING (doc_id)""")
def score_cases(t):
    good = F.col("quality") == 1
    o = t.labels.select(F.col("doc_id").alias("case_id"), F.when(good, "allowed").otherwise("rejected").alias("status"), F.when(good, "ALLOWED").otherwise(F.concat(F.lit("SCOPE_MISMATCH:"), F.col("toxic").cast("string"))).alias("reason"))
    third = F.col("doc_id") % 3 == 0
    e = t.documents.select(F.col("doc_id").alias("case_id"), F.when(third, "rejected").otherwise("allowed").alias("expected_status"), F.when(third, "SCOPE").alias("expected_reason"))
    return rules.score_cases(o, e)


BIND = """a AS (SELECT o_orderkey AS id, 's' || (o_orderkey % 3) AS s
  FROM orders), b AS (SELECT l_orderkey AS id, 'r' || l_linenumber AS r, l_linenumber = 3 AS nested,
  CASE WHEN l_linenumber = 3 THEN l_orderkey + l_suppkey % 5 ELSE l_partkey END AS f FROM lineitem)"""


def bindings(t):
    n, k = F.col("l_linenumber"), F.col("l_orderkey")
    return t.lineitem.select(k.alias("assertion_id"), F.concat(F.lit("r"), n.cast("string")).alias("role_id"), F.when(n == 3, "assertion").otherwise("entity").alias("filler_kind"), F.when(n == 3, k + F.col("l_suppkey") % 5).otherwise(F.col("l_partkey")).alias("filler_id"))


def assertions(t):
    return t.orders.select(F.col("o_orderkey").alias("assertion_id"), F.concat(F.lit("s"), (F.col("o_orderkey") % 3).cast("string")).alias("schema_id"))


def schema_roles(t):
    """Role r3 may be filled by any assertion in schema s0, by one of schema s1 in the others; r4 must be filled by one of schema s1."""
    i = t.spark.range(3).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("schema_id"), "id", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("i"))
    return i.select("schema_id", F.concat(F.lit("r"), F.col("i").cast("string")).alias("role_id"), F.when((F.col("i") == 4) | ((F.col("i") == 3) & (F.col("id") > 0)), "s1").alias("filler_schema"), F.when(F.col("i") == 1, 1).otherwise(0).alias("min_count"), F.lit(2).alias("max_count"))


NESTED = f"""{BIND}, nf AS (SELECT b.id, b.r, b.f,
  CASE WHEN a.s IS NULL THEN 'UNKNOWN_ASSERTION' WHEN r = 'r7' THEN 'UNDECLARED_ROLE' WHEN nested AND f = b.id THEN 'SELF_REFERENCE' WHEN nested AND x.s IS NULL THEN 'MISSING_ASSERTION' WHEN NOT nested AND r = 'r4' THEN 'ASSERTION_EXPECTED' WHEN nested AND a.s <> 's0' AND x.s <> 's1' THEN 'WRONG_SCHEMA' END AS code
  FROM b LEFT JOIN a ON a.id = b.id LEFT JOIN a x ON x.id = b.f)"""


@query(f"WITH {NESTED} SELECT id AS assertion_id, r AS role_id, f AS filler_id, code FROM nf WHERE code IS NOT NULL")
def nested_fillers(t):
    return rules.nested_filler_violations(assertions(t), bindings(t), schema_roles(t))


@query(f"""WITH {NESTED}, n AS (SELECT id, r, count(*) AS n FROM b GROUP BY 1, 2) SELECT id AS assertion_id, r AS role_id, code FROM nf WHERE code IS NOT NULL
UNION ALL SELECT n.id, n.r, 'TOO_MANY' FROM n JOIN a ON a.id = n.id WHERE n > 2 AND r <> 'r7' UNION ALL SELECT id, 'r1', 'TOO_FEW' FROM a
  WHERE id NOT IN (SELECT id FROM n WHERE r = 'r1')""")
def validate_assertions(t):
    return rules.validate_assertions(assertions(t), bindings(t), schema_roles(t))


PROJECT = f"""{BIND}, pr AS (SELECT b.id AS assertion_id, 'edge' AS projection_id, string_agg(CASE WHEN r IN ('r1', 'r2') THEN r || '=' || f END, ','
  ORDER BY r || '=' || f) AS kept, string_agg(CASE WHEN r IN ('r1', 'r2') THEN r || '=' || f END, ',' ORDER BY r || '=' || f) AS endpoints,
  string_agg(CASE WHEN r NOT IN ('r1', 'r2') THEN r || '=' || f END, ',' ORDER BY r || '=' || f) AS lost,
  CASE WHEN any_value(s) = 's1' THEN 'lossless' ELSE 'lossy' END AS loss, count_if(r = 'r1') = 1 AND count_if(r = 'r2') = 1 AS fine FROM b
  JOIN a ON a.id = b.id WHERE s <> 's2' GROUP BY b.id)"""


def _projected(t):
    roles = lambda *n: F.array(*[F.lit(f"r{i}") for i in n])
    rule = t.spark.range(2).select(F.lit("edge").alias("projection_id"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("schema_id"), roles(1, 2).alias("selected"), roles(1, 2).alias("endpoints"), roles(3, 4, 5, 6, 7).alias("omitted"), F.when(F.col("id") == 1, "lossless").otherwise("lossy").alias("loss"))
    return rules.project_assertions(bindings(t).join(assertions(t), "assertion_id").withColumn("filler_id", F.col("filler_id").cast("string")), rule)


@query(f"WITH {PROJECT} SELECT assertion_id, projection_id, coalesce(kept, '') AS kept, coalesce(endpoints, '') AS endpoints, coalesce(lost, '') AS lost, loss, CASE WHEN NOT fine THEN 'ENDPOINT_NOT_SINGLE' WHEN lost IS NOT NULL AND loss = 'lossless' THEN 'LOSS_NOT_DECLARED' ELSE 'projected' END AS status FROM pr")
def project_assertions(t):
    return _projected(t)


@query(f"WITH {PROJECT} SELECT assertion_id, projection_id, fine AND lost IS NULL AND loss = 'lossless' AS canonical FROM pr")
def equivalence_claims(t):
    return rules.equivalence_claims(_projected(t))


# consecutive orders as sentence pairs
PAIRS = """pa AS (SELECT a.o_orderkey AS k, a.o_orderpriority AS pa, b.o_orderpriority AS pb,
  CASE WHEN a.o_orderkey % 3 = 0 THEN 'closeMatch' WHEN a.o_orderkey % 3 = 1 THEN 'related' END AS relation, a.o_custkey % 5 AS xa, b.o_custkey % 4 AS xb, a.o_custkey % 3 AS ya, b.o_custkey % 2 AS yb, a.o_orderstatus AS sa, b.o_orderstatus AS sb
  FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1)"""


def pairs(t):
    a = t.orders.alias("a").join(t.orders.alias("b"), F.col("b.o_orderkey") == F.col("a.o_orderkey") + 1)
    k = F.col("a.o_orderkey")
    m = lambda s, x, y: F.create_map(F.lit("agent"), (F.col(f"{s}.o_custkey") % x).cast("string"), F.lit("theme"), (F.col(f"{s}.o_custkey") % y).cast("string"))
    return a.select(k.alias("k"), F.col("a.o_orderpriority").alias("predicate_a"), F.col("b.o_orderpriority").alias("predicate_b"), F.when(k % 3 == 0, "closeMatch").when(k % 3 == 1, "related").alias("relation"), m("a", 5, 3).alias("roles_a"), m("b", 4, 2).alias("roles_b"), F.create_map(F.lit("agent"), F.lit("theme"), F.lit("theme"), F.lit("agent")).alias("names"), F.array("a.o_orderstatus").alias("stance_a"), F.array("b.o_orderstatus").alias("stance_b"))


@query(f"WITH {PAIRS} SELECT k, coalesce((pa = pb OR relation = 'closeMatch') AND ((xa = xb AND ya = yb) OR (xa = yb AND ya = xb)) AND sa = sb, false) AS collapsed FROM pa")
def decide_collapse(t):
    return rules.decide_collapse(pairs(t), ["exactMatch", "closeMatch"]).select("k", "collapsed")


@query(f"WITH {PAIRS} SELECT k, CAST(least(xa, ya) AS VARCHAR) AS low, CAST(greatest(xa, ya) AS VARCHAR) AS high, (xa = xb AND ya = yb) OR (xa = yb AND ya = xb) AS matches FROM pa")
def participants_match(t):
    p = pairs(t)
    n = V.interchanged(F.col("roles_a"), F.lit("agent"), F.lit("theme"))
    return p.select("k", n["agent"].alias("low"), n["theme"].alias("high"), V.participants_match(F.col("roles_a"), F.col("roles_b"), F.col("names")).alias("matches"))


@query(f"""WITH {PAIRS} SELECT k,
  CASE WHEN k % 10 = 0 THEN 'no_expected_predicates' WHEN pa = '1-URGENT' THEN 'schema_blocked' WHEN sa <> 'F' THEN 'out_of_scope' ELSE 'scoreable' END AS triage
  FROM pa""")
def triage_pairs(t):
    p, k = pairs(t), F.col("k")
    expected = F.when(k % 10 == 0, F.array().cast("array<string>")).otherwise(F.array("predicate_a"))
    return p.select("k", rules.triage(expected, F.col("predicate_a") == "1-URGENT", F.col("stance_a")[0] == "F").alias("triage"))


# either side of a pair of orders has one or two acceptable priorities; the relations between priorities come from parts
REACH = f"""{PAIRS}, ls AS (SELECT k, sa = 'F' AS same, k % 4 = 0 AS fine,
  CASE WHEN k % 10 = 0 THEN [] WHEN k % 3 = 0 THEN list_sort([pa, '3-MEDIUM']) ELSE [pa] END AS a,
  CASE WHEN k % 3 = 0 THEN list_sort([pb, '3-MEDIUM']) ELSE [pb] END AS b FROM pa),
pr AS (SELECT DISTINCT o_orderpriority AS p FROM orders), rel AS (SELECT x.p AS x, y.p AS y FROM pr x JOIN pr y ON x.p < y.p
  WHERE (CAST(left(x.p, 1) AS INTEGER) + CAST(left(y.p, 1) AS INTEGER)) % 3 = 0)"""


@query(f"""WITH {REACH} SELECT k AS pair_id, CASE WHEN len(a) = 0 THEN 'no_expected_predicates' WHEN same AND a = b THEN 'same_via_identical_predicate'
WHEN same AND EXISTS (SELECT 1 FROM rel
  WHERE (list_contains(a, x) AND list_contains(b, y)) OR (list_contains(a, y) AND list_contains(b, x))) THEN 'same_via_declared_relation' WHEN same THEN 'same_UNREACHABLE' WHEN a <> b THEN 'diff_via_distinct_predicate'
WHEN fine THEN CASE WHEN (SELECT count(DISTINCT l_returnflag) = 2 AND bool_or(l_shipdate IS NOT NULL) FROM lineitem
  WHERE l_returnflag IN ('A', 'R')) THEN 'diff_via_modifier' ELSE 'diff_UNREACHABLE' END ELSE 'diff_needs_roles' END AS bucket FROM ls""")
def reachability_buckets(t):
    k, third = F.col("k"), F.col("k") % 3 == 0
    side = lambda c: F.when(third, F.array(F.col(c), F.lit("3-MEDIUM"))).otherwise(F.array(c))
    empty = F.array().cast("array<string>")
    p = pairs(t).select(
        k.alias("pair_id"),
        F.when(F.col("stance_a")[0] == "F", "same-object").otherwise("different").alias("label"),
        F.when(k % 4 == 0, "granularity").otherwise("roles").alias("failure_mode"),
        F.when(k % 10 == 0, empty).otherwise(side("predicate_a")).alias("predicates_a"),
        side("predicate_b").alias("predicates_b"),
    )
    names = t.orders.select("o_orderpriority").distinct()
    both = names.select(F.col("o_orderpriority").alias("from_id")).join(names.select(F.col("o_orderpriority").alias("to_id")), F.col("from_id") < F.col("to_id"))
    total = F.left("from_id", F.lit(1)).cast("int") + F.left("to_id", F.lit(1)).cast("int")
    rel = both.select(F.col("to_id").alias("from_id"), F.col("from_id").alias("to_id"), F.when(total % 3 == 0, "closeMatch").otherwise("related").alias("relation"), F.lit(0).alias("ord"))
    declared = rules.modifiers_declared(t.lineitem.select(F.col("l_returnflag").alias("label")), t.lineitem.select(F.when(F.col("l_shipdate").isNotNull(), "inflection").alias("value_type_id")), ["A", "R"], "inflection")
    return rules.reachability(p, rel, ["exactMatch", "closeMatch"], declared.select("declared").scalar())


@query("""SELECT 's' || (p_size % 11) AS schema_id, count(*) AS n_roles, CAST(count_if(p_partkey % 4 <> 0) AS BIGINT) AS grounded, CAST(count_if(p_partkey % 4 = 0) AS BIGINT) AS ungrounded, CAST(count_if(p_partkey % 3 = 0 OR p_partkey % 3 > 1) AS BIGINT) AS repeatable
  FROM part GROUP BY 1""")
def schema_profile(t):
    k = F.col("p_partkey")
    return rules.schema_profile(t.part.select(F.concat(F.lit("s"), (F.col("p_size") % 11).cast("string")).alias("schema_id"), F.when(k % 4 != 0, "g").alias("grounded_role"), F.when(k % 3 != 0, k % 3).alias("max_count")))


# events of a user as the observations of an episode
OBSERVED = """ob AS (SELECT user_id AS episode, event_id AS obs_id, epoch_ms(ts) AS ms, event_id % 10 AS kind,
  CASE WHEN user_id % 3 = 0 THEN 2 + value / 1000 WHEN user_id % 3 = 1 THEN CASE WHEN event_id % 2 = 0 THEN value / 100 ELSE value END ELSE value / 10 END AS pressure, 0.1 + user_id % 5 / 100.0 AS z
  FROM events),
pr AS (SELECT episode, avg(pressure) AS mean, max(pressure) - min(pressure) AS spread, arg_min(pressure, (ms, pressure)) AS first, arg_max(pressure, (ms, pressure)) AS last
  FROM ob WHERE kind < 6 GROUP BY 1),
po AS (SELECT episode, avg(z) AS z FROM ob WHERE kind IN (6, 7) GROUP BY 1),
st AS (SELECT e.episode, CASE WHEN e.episode % 2 = 0 AND po.z - 0.1 > 0.02 THEN 'no_contact' WHEN (first > 1) <> (last > 1) THEN 'transient_contact' WHEN mean > 1 AND spread < 1 THEN 'direct_contact' ELSE 'unknown' END AS state
  FROM (SELECT DISTINCT episode FROM ob) e LEFT JOIN pr USING (episode) LEFT JOIN po USING (episode))"""


def observations(t):
    """A user with an even number has the reference surface in the first of its observations."""
    k, u, v = F.col("event_id"), F.col("user_id"), F.col("value")
    kind = k % 10
    channel = F.when(kind < 6, "pressure_sensor").when(kind < 8, "position_tracker").when(kind == 8, "camera_overhead").otherwise("thermometer")
    pressure = F.when(u % 3 == 0, v / 1000 + 2).when(u % 3 == 1, F.when(k % 2 == 0, v / 100).otherwise(v)).otherwise(v / 10)
    return t.events.select(u.alias("episode"), k.alias("obs_id"), k.alias("ord"), channel.alias("channel"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"), pressure.alias("value"), (u % 5 / 100.0 + 0.1).alias("z"), F.when(u % 2 == 0, "surface_B_height_0.1m").alias("reference"))


@query(f"""WITH {OBSERVED} SELECT episode, state, CAST(CASE state WHEN 'no_contact' THEN 0.94 WHEN 'transient_contact' THEN 0.92 WHEN 'direct_contact' THEN 0.95 ELSE 0.5 END AS DOUBLE) AS confidence, (SELECT string_agg(CAST(obs_id AS VARCHAR), ','
  ORDER BY obs_id) FROM ob WHERE ob.episode = st.episode AND kind < 9) AS evidence FROM st""")
def contact_states(t):
    return rules.contact_states(observations(t)).withColumn("evidence", F.array_join(F.col("evidence").cast("array<string>"), ",", ""))


@query(f"""WITH {OBSERVED}, ep AS (SELECT st.*, ['support', 'obstruction', 'attachment', 'posture_persistence', 'posture_identity_adversarial', 'other'][episode % 6 + 1] AS t, g, n
  FROM st JOIN (SELECT user_id AS episode, max(CAST(value * 20 AS BIGINT)) AS g, count(DISTINCT event_type) AS n FROM events WHERE event_id % 3 = 0
  GROUP BY 1) USING (episode))
SELECT episode, CASE WHEN t = 'obstruction' AND state = 'no_contact' THEN 'visual_occlusion_not_support' WHEN t = 'attachment' AND state = 'transient_contact' THEN 'transient_contact_not_attachment' WHEN t = 'posture_identity_adversarial' AND g > 3000 THEN 'identity_unknown_insufficient_evidence' WHEN t = 'posture_identity_adversarial' AND n > 1 THEN 'multiple_indistinguishable_instances' WHEN t LIKE 'posture%' THEN 'persistent_identity_stable_pose' ELSE 'support' END AS classification,
CAST(CASE WHEN t = 'support' AND state = 'direct_contact' THEN 0.98 WHEN t = 'obstruction' AND state = 'no_contact' THEN 0.97 WHEN t = 'attachment' AND state = 'transient_contact' THEN 0.96 WHEN t = 'posture_persistence' THEN 0.95 WHEN t = 'posture_identity_adversarial' THEN CASE WHEN g > 3000 THEN 0.99 WHEN n > 1 THEN 0.98 ELSE 0.95 END ELSE 0.5 END AS DOUBLE) AS confidence
  FROM ep""")
def classify_episodes(t):
    names = F.array(*[F.lit(x) for x in ("support", "obstruction", "attachment", "posture_persistence", "posture_identity_adversarial", "other")])
    seen = t.events.filter("event_id % 3 = 0").groupBy(F.col("user_id").alias("episode")).agg(F.max(F.round(F.col("value") * 20).cast("long")).alias("max_gap_ms"), F.count_distinct("event_type").alias("instance_count"))
    episodes = seen.select("episode", F.element_at(names, (F.col("episode") % 6 + 1).cast("int")).alias("episode_type"))
    return rules.classify_episodes(episodes, rules.contact_states(observations(t)), seen)


# documents as modules; the notice of the approved ones is a phrase of their licence line
HEADS = """hd AS (SELECT doc_id, text, lower(array_to_string(regexp_split_to_array(text, '\\r\\n|\\r|\\n')[1:120], chr(10))) AS h
  FROM documents), cl AS (SELECT doc_id, text, contains(h, 'licensed under') AND contains(h, '4.0') AS n, contains(h, 'gnu lesser general public') AS l, contains(h, 'gnu general public') OR contains(h, 'gnu public license') AS g, contains(h, 'creative commons') OR contains(h, 'create commons') AS c
  FROM hd),
hc AS (SELECT doc_id, text, doc_id % 2 = 0 AS ok,
  CASE WHEN doc_id % 2 = 0 AND n THEN 'approved_notice' WHEN CAST(l AS INTEGER) + CAST(g AS INTEGER) + CAST(c AS INTEGER) > 1 THEN 'mixed' WHEN l THEN 'lgpl' WHEN g THEN 'gpl' WHEN c THEN 'cc' ELSE 'unclassified' END AS kind
  FROM cl)"""
NOTICE = ["licensed under", "4.0"]


@query(f"WITH {HEADS} SELECT doc_id AS path, sha256(text) AS sha256, kind AS header_class, CASE WHEN ok THEN 'approved_for_bounded_context' ELSE 'excluded_pending_module_specific_review' END AS disposition FROM hc")
def publication_dispositions(t):
    k = F.col("doc_id").alias("path")
    return rules.dispositions(t.documents.select(k, "text"), t.documents.filter("doc_id % 2 = 0").select(k), NOTICE)


@query("""SELECT doc_id AS path, CASE WHEN doc_id % 5 = 0 THEN 'MODULE_UNREADABLE' ELSE 'MODULE_IDENTITY_CHANGED' END AS code FROM documents
  WHERE doc_id % 5 = 0 OR doc_id % 7 = 0 OR doc_id % 11 = 0""")
def module_identity(t):
    """Of all documents, approved or not, those that are gone or have another hash or length than declared."""
    k, sha, size = F.col("doc_id"), F.sha2("text", 256), F.octet_length("text")
    declared = t.documents.select(k.alias("path"), F.when(k % 7 == 0, "-").otherwise(sha).alias("sha256"), F.when(k % 11 == 0, size + 1).otherwise(size).alias("byte_count"))
    return rules.module_identity(declared, t.documents.filter(k % 5 > 0).select(k.alias("path"), sha.alias("sha256"), size.alias("length")))


@query("""WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls
  FROM documents), n AS (SELECT *, len(ls) - CASE WHEN ls[-1] = '' THEN 1 ELSE 0 END AS lines, array_to_string(list_transform(ls[2:3], lambda x: rtrim(x)), chr(10)) || chr(10) AS notice
  FROM d),
c AS (SELECT *, CASE WHEN doc_id % 5 = 0 THEN 'MODULE_ABSENT' WHEN lines < 3 THEN 'NOTICE_RANGE' WHEN NOT contains(notice, 'th') OR NOT contains(notice, '.') THEN 'GRANT_MISSING' END AS code
  FROM n)
SELECT doc_id AS path, code, CASE WHEN code IS NULL THEN 'SUMO bounded linguistic context' || chr(10) || 'Source: https://github.com/ontologyportal/sumo at c0ffee' || chr(10) || 'Source module: ' || doc_id || ' (' || sha256(text) || ')' || chr(10) || 'Acknowledgement: thanks' || chr(10)
 || 'Only derived bounded facts are packaged; the raw module and full projection are not.' || chr(10) || chr(10) || 'Exact source license notice:' || chr(10) || notice END AS attribution,
  CASE WHEN code IS NULL THEN sha256(notice) END AS notice_sha256 FROM c""")
def attributions(t):
    """Lines two and three of each document as its notice, which must hold two phrases."""
    k = F.col("doc_id").alias("path")
    approved = t.documents.select(k, F.sha2("text", 256).alias("sha256"), F.lit("thanks").alias("acknowledgement"), F.lit(2).alias("first_line"), F.lit(3).alias("last_line"))
    return rules.attributions(t.documents.filter("doc_id % 5 > 0").select(k, "text"), approved, "c0ffee", ["th", "."])


@query(f"WITH {HEADS}, ap AS (SELECT doc_id AS path, CASE WHEN doc_id % 6 = 0 THEN '-' ELSE sha256(text) END AS s FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT -page_id - 1, '-' FROM pages) SELECT path, CASE WHEN kind IS NULL THEN 'APPROVED_MODULE_ABSENT' WHEN s <> sha256(text) THEN 'APPROVED_HASH_CHANGED' ELSE 'APPROVED_NOTICE_MISSING' END AS code FROM ap LEFT JOIN hc ON doc_id = path WHERE kind IS NULL OR s <> sha256(text) OR kind <> 'approved_notice'")
def publication_violations(t):
    k = F.col("doc_id")
    approved = t.documents.filter("doc_id % 2 = 0").select(k.alias("path"), F.when(k % 6 == 0, "-").otherwise(F.sha2("text", 256)).alias("sha256"))
    approved = approved.unionByName(t.pages.select((-F.col("page_id") - 1).alias("path"), F.lit("-").alias("sha256")))
    return rules.publication_violations(t.documents.select(k.alias("path"), "text"), approved, NOTICE)


@query("""SELECT projection_id, code FROM (SELECT c_custkey AS projection_id, unnest([CASE WHEN c_custkey % 2 = 0 THEN 'ROLES_NOT_COVERED' END,
  CASE WHEN c_custkey % 3 = 0 THEN 'SELECTED_AND_OMITTED' END, CASE WHEN c_custkey % 5 = 0 THEN 'EDGE_NEEDS_TWO_ENDPOINTS' END,
  CASE WHEN c_custkey % 7 = 0 THEN 'LOSSLESS_WITH_OMISSION' END]) AS code FROM customer) WHERE code IS NOT NULL""")
def projection_rule_check(t):
    k = F.col("c_custkey")
    arr = lambda *x: F.array(*[F.lit(v) for v in x])
    r = t.customer.select(k.alias("projection_id"), F.when(k % 2 == 0, arr("a", "b", "c", "d")).otherwise(arr("a", "b", "c")).alias("roles"), arr("a", "b").alias("selected"), F.when(k % 3 == 0, arr("c", "a")).otherwise(arr("c")).alias("omitted"), F.when(k % 5 == 0, arr("a", "a")).otherwise(arr("a", "b")).alias("endpoints"), F.lit("edge").alias("target_view"), F.when(k % 7 == 0, "lossless").otherwise("lossy").alias("loss"))
    return checks.projection_rule_violations(r)


@query("SELECT conv_id, turn, array_to_string(regexp_extract_all('<e>' || text || '</e> x <e>' || role || '</e>', '(?s)<e>(.*?)</e>', 1), '|') AS found FROM conversations")
def tagged_json(t):
    text = F.concat(F.lit("<e>"), "text", F.lit("</e> x <e>"), "role", F.lit("</e>"))
    return t.conversations.select("conv_id", "turn", F.array_join(X.tagged_json(text, "e"), "|").alias("found"))
