"""Identifiers, crosswalk, index reconciliation, roles and pairs."""

from pyspark.sql import functions as F

from crosslink.functions import ids
from crosslink.operators import checks, match
from crosslink.operators import metrics as M
from crosslink.plans.base import DONORS, MATCHED, SOURCES, donors, matched, query, sources


@query(f"WITH {MATCHED} SELECT * FROM matched")
def id_match_status(t):
    return matched(t)


def mappings(t):
    """Donor ids as mappings; candidates have a method, its scope and a confidence."""
    candidate = F.length("donor_id") % 2 != 0
    return donors(t).select(
        F.concat(F.lit("lc:"), F.lower("donor_id")).alias("canonical_id"),
        F.lit("predicate").alias("canonical_kind"),
        F.col("family").alias("source_key"),
        F.when(F.col("family") == "MACHINERY", F.concat("donor_id", F.lit(":ARG1"))).otherwise(F.col("donor_id")).alias("source_id"),
        F.when(candidate, "candidate_alignment").otherwise("derived_from").alias("relation"),
        F.when(candidate, "donor_asserted").otherwise("direct_identifier").alias("producer_method"),
        F.when(candidate, 0.5).alias("producer_confidence"),
        F.when(candidate, "unknown").alias("producer_method_scope"),
        F.concat(F.lit("predicates[name="), "donor_id", F.lit("].name")).alias("evidence_ref"),
    )


MAPPINGS = f"""{MATCHED}, maps AS (SELECT 'lc:' || lower(donor_id) AS canonical_id, 'predicate' AS canonical_kind, family AS source_key,
  CASE WHEN family = 'MACHINERY' THEN donor_id || ':ARG1' ELSE donor_id END AS source_id,
  CASE WHEN length(donor_id) % 2 = 0 THEN 'derived_from' ELSE 'candidate_alignment' END AS relation,
  CASE WHEN length(donor_id) % 2 = 0 THEN 'direct_identifier' ELSE 'donor_asserted' END AS producer_method,
  CASE WHEN length(donor_id) % 2 <> 0 THEN CAST(0.5 AS DOUBLE) END AS producer_confidence,
  CASE WHEN length(donor_id) % 2 <> 0 THEN 'unknown' END AS producer_method_scope, 'predicates[name=' || donor_id || '].name' AS evidence_ref
  FROM donors),
cross_ AS (SELECT m.*, 'lcx1_' || substr(sha256(concat_ws(chr(0), canonical_id, source_key, source_id, relation, evidence_ref)), 1, 24) AS record_id,
  CASE status WHEN 'matched' THEN 'exact' WHEN 'missing' THEN 'missing' WHEN 'invalid' THEN 'invalid' ELSE 'not_applicable' END AS identity_state,
  CASE WHEN relation = 'candidate_alignment' THEN 'candidate' ELSE 'unresolved' END AS state, 'not_reviewed' AS review_status
  FROM maps m LEFT JOIN matched x ON x.family = m.source_key AND x.donor_id = CASE WHEN m.source_key = 'MACHINERY' THEN regexp_replace(m.source_id, ':[^:]*$', '') ELSE m.source_id END)"""


def cross(t):
    return match.crosswalk(mappings(t), matched(t), "MACHINERY")


@query(f"WITH {MAPPINGS} SELECT * FROM cross_")
def crosswalk(t):
    return cross(t)


@query(f"""WITH {MATCHED}, d AS (SELECT family, count(DISTINCT donor_id) AS donor_ids, count_if(status = 'matched') AS matched, count_if(status = 'missing') AS missing, count_if(status = 'invalid') AS invalid,
  count_if(status = 'source_unavailable') AS unavailable, count(DISTINCT CASE WHEN status = 'matched' THEN normal_id END) AS hit, count(*) || '-' || sum(CAST(CAST('0x' || substr(sha256('v' || donor_id), 1, 14) AS BIGINT) AS HUGEINT)) AS donor_digest
  FROM (SELECT DISTINCT * FROM matched) GROUP BY family),
s AS (SELECT family, count(DISTINCT source_id) AS source_ids FROM sources GROUP BY family)
SELECT family, coalesce(source_ids, 0) AS source_ids, CAST(coalesce(donor_ids, 0) AS BIGINT) AS donor_ids, CAST(coalesce(matched, 0) AS BIGINT) AS matched, CAST(coalesce(missing, 0) AS BIGINT) AS missing, CAST(coalesce(invalid, 0) AS BIGINT) AS invalid,
  CAST(coalesce(unavailable, 0) AS BIGINT) AS unavailable, CAST(coalesce(source_ids, 0) - coalesce(hit, 0) AS BIGINT) AS extra, donor_digest FROM d FULL JOIN s USING (family)""")
def identity_coverage(t):
    return M.identity_coverage(matched(t), sources(t))


@query(f"""WITH {MAPPINGS} SELECT source_key, CAST(count_if(identity_state = 'exact') AS BIGINT) AS n_exact, CAST(count_if(identity_state = 'missing') AS BIGINT) AS n_missing, CAST(count_if(identity_state = 'invalid') AS BIGINT) AS n_invalid,
  CAST(count_if(identity_state = 'not_applicable') AS BIGINT) AS n_not_applicable, count(*) AS n_total FROM cross_ GROUP BY source_key""")
def status_counts(t):
    return M.status_counts(cross(t), ["source_key"], "identity_state", ["exact", "missing", "invalid", "not_applicable"])


@query(f"""WITH {MATCHED}, n AS (SELECT count(*) AS n, count_if(status = 'matched') AS a, count_if(status = 'missing') AS b, count_if(status = 'invalid') AS c, count_if(status = 'source_unavailable') AS d, count(DISTINCT donor_id) AS u
  FROM matched)
SELECT 'parts_sum' AS "check", CAST(n AS BIGINT) AS lhs, CAST(a + b + c + d AS BIGINT) AS rhs, n = a + b + c + d AS ok FROM n UNION ALL SELECT 'ids_unique', n, u, n = u FROM n""")
def reconcile_equations(t):
    n = matched(t).agg(F.count("*").alias("n"), *[M.n_if(F.col("status") == s).alias(s) for s in ("matched", "missing", "invalid", "source_unavailable")], F.count_distinct("donor_id").alias("u"))
    return checks.reconcile(n, {"parts_sum": (F.col("n"), F.col("matched") + F.col("missing") + F.col("invalid") + F.col("source_unavailable")), "ids_unique": (F.col("n"), F.col("u"))})


@query(f"WITH {MATCHED}, p AS (SELECT status, count(*) AS n, array_to_string(list_sort(list(DISTINCT family)), ',') AS families FROM matched GROUP BY status) SELECT * FROM p")
def distinct_labels(t):
    m = matched(t)
    labels = M.distinct_labels(m, "status", "family").select("status", F.array_join("labels", ",").alias("families"))
    return m.groupBy("status").agg(F.count("*").alias("n")).join(labels, "status")


@query("""WITH d AS (SELECT o_orderkey AS id, o_custkey % 7 AS v FROM orders WHERE o_orderkey % 3 <> 0), o AS (SELECT o_orderkey AS id,
  CASE WHEN o_orderkey % 11 = 0 THEN 9 ELSE o_custkey % 7 END AS v FROM orders WHERE o_orderkey % 4 <> 0)
SELECT coalesce(d.id, o.id) AS id, CASE WHEN o.id IS NULL THEN 'missing' WHEN d.id IS NULL THEN 'extra' WHEN d.v IS DISTINCT
  FROM o.v THEN 'drift' ELSE 'ok' END AS status FROM d FULL JOIN o ON d.id = o.id""")
def reconcile_index(t):
    rows = t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 7).alias("v"))
    return match.reconcile_index(rows.filter("id % 3 <> 0"), rows.filter("id % 4 <> 0").withColumn("v", F.when(F.col("id") % 11 == 0, 9).otherwise(F.col("v"))), "id", "v")


@query("""SELECT 'customer' AS kind, CAST(c AS VARCHAR) AS ref FROM (SELECT DISTINCT o_custkey AS c FROM orders) WHERE c NOT IN (SELECT c_custkey
  FROM customer WHERE c_custkey % 9 <> 0)
UNION ALL SELECT 'part', CAST(p AS VARCHAR) FROM (SELECT DISTINCT l_partkey AS p FROM lineitem) WHERE p NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 13 <> 0)""")
def dangling_refs(t):
    return checks.dangling({"customer": (t.orders, "o_custkey"), "part": (t.lineitem, "l_partkey")}, {"customer": (t.customer.filter("c_custkey % 9 <> 0"), "c_custkey"), "part": (t.part.filter("p_partkey % 13 <> 0"), "p_partkey")})


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(t):
    return checks.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""SELECT 'p_brand->p_type' AS side, p_brand AS value, count(DISTINCT p_type) AS n FROM part GROUP BY p_brand HAVING count(DISTINCT p_type) > 1
UNION ALL SELECT 'p_type->p_brand', p_type, count(DISTINCT p_brand) FROM part GROUP BY p_type HAVING count(DISTINCT p_brand) > 1""")
def functional_dependency(t):
    return checks.dependency_violations(t.part, "p_brand", "p_type")


@query("""WITH a AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), b AS (SELECT o_custkey, count(*) AS n
  FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1)
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.n, 0) AS n_left, coalesce(b.n, 0) AS n_right FROM a FULL
  JOIN b ON a.o_custkey = b.o_custkey WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def multiset_equal(t):
    return checks.multiset_difference(t.orders.filter("o_orderkey % 2 = 0"), t.orders.filter("o_orderkey % 2 = 1"), ["o_custkey"])


@query("SELECT source AS id, array_to_string(list_sort(list(DISTINCT lang)), ',') AS paths FROM documents GROUP BY source HAVING count(DISTINCT lang) > 1")
def identity_conflicts(t):
    return checks.identity_conflicts(t.documents, "source", "lang").select(F.col("source").alias("id"), F.array_join("paths", ",").alias("paths"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_extendedprice, l_shipdate) AS r FROM lineitem) WHERE r = 1""")
def first_seen(t):
    from crosslink.operators.windows import first_seen

    return first_seen(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


ROLES = """roles AS (SELECT l_orderkey AS predicate_id, l_linenumber AS arg, arg_max(l_partkey, (l_extendedprice, l_partkey)) AS role FROM lineitem GROUP BY 1, 2)"""


def roles(t):
    return t.lineitem.select(F.col("l_orderkey").alias("predicate_id"), F.col("l_linenumber").alias("arg"), F.col("l_partkey").alias("role"), F.col("l_extendedprice").alias("ord"))


@query(f"""WITH {ROLES}, rel AS (SELECT o_orderkey AS from_id, o_orderkey + 1 AS to_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'exactMatch' WHEN '2-HIGH' THEN 'closeMatch' ELSE 'related' END AS relation
  FROM orders)
SELECT from_id, to_id, relation, a.arg, a.role AS from_role, b.role AS to_role, CASE WHEN from_id % 10 = 0 AND a.arg = 1 THEN 'skipped_divergent' ELSE 'aligned' END AS status
FROM rel JOIN roles a ON a.predicate_id = from_id JOIN roles b ON b.predicate_id = to_id AND b.arg = a.arg WHERE relation IN ('exactMatch', 'closeMatch')""")
def role_correspondences(t):
    p = F.col("o_orderpriority")
    rel = t.orders.select(F.col("o_orderkey").alias("from_id"), (F.col("o_orderkey") + 1).alias("to_id"), F.when(p == "1-URGENT", "exactMatch").when(p == "2-HIGH", "closeMatch").otherwise("related").alias("relation"))
    off = rel.filter("from_id % 10 = 0").select("from_id", "to_id", F.lit(1).alias("arg"))
    return match.role_correspondences(rel, roles(t), ["exactMatch", "closeMatch"], off)


@query("SELECT DISTINCT a.l_orderkey, a.l_linenumber AS l_linenumber_a, b.l_linenumber AS l_linenumber_b FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber")
def pair_within_group(t):
    return match.pairs_within(t.lineitem, "l_orderkey", "l_linenumber")


@query(f"""WITH {ROLES} SELECT o_orderkey AS predicate_id, a.k AS arg_a, b.k AS arg_b, x.role AS role_a, y.role AS role_b,
CASE WHEN x.role IS NULL AND y.role IS NULL THEN 'both_unresolved' WHEN x.role IS NULL THEN 'first_unresolved' WHEN y.role IS NULL THEN 'second_unresolved' ELSE 'resolved' END AS status
FROM orders, (SELECT 1 AS k) a, (SELECT 3 AS k) b LEFT JOIN roles x ON x.predicate_id = o_orderkey AND x.arg = a.k LEFT
  JOIN roles y ON y.predicate_id = o_orderkey AND y.arg = b.k""")
def resolve_symmetric_pairs(t):
    place = roles(t).groupBy("predicate_id", "arg").agg(F.max_by("role", F.struct("ord", "role")).alias("role"))
    return match.resolve_pairs(t.orders.select(F.col("o_orderkey").alias("predicate_id"), F.lit(1).alias("arg_a"), F.lit(3).alias("arg_b")), place)


@query("""WITH rel AS (SELECT least(o_custkey, o_orderkey % 500) AS lo, greatest(o_custkey, o_orderkey % 500) AS hi, arg_max(o_orderpriority, (o_orderkey, o_orderpriority)) AS relation
  FROM orders GROUP BY 1, 2)
SELECT l_orderkey % 500 AS a, l_partkey % 1500 AS b, relation, count(*) AS n FROM lineitem LEFT
  JOIN rel ON lo = least(l_orderkey % 500, l_partkey % 1500) AND hi = greatest(l_orderkey % 500, l_partkey % 1500) GROUP BY 1, 2, 3""")
def lookup_unordered_pair(t):
    rel = t.orders.select(F.col("o_custkey").alias("a"), (F.col("o_orderkey") % 500).alias("b"), F.col("o_orderpriority").alias("relation"), F.col("o_orderkey").alias("ord"))
    pairs = t.lineitem.select((F.col("l_orderkey") % 500).alias("a"), (F.col("l_partkey") % 1500).alias("b")).groupBy("a", "b").agg(F.count("*").alias("n"))
    return match.unordered_relations(pairs, rel).select("a", "b", "relation", "n")


@query("""WITH rel AS (SELECT least(o_custkey, o_orderkey % 500) AS lo, greatest(o_custkey, o_orderkey % 500) AS hi, arg_max(o_orderpriority, (o_orderkey, o_orderpriority)) AS relation
  FROM orders GROUP BY 1, 2),
r AS (SELECT p_partkey AS id, [p_partkey % 500, p_partkey % 41] AS xs, [p_partkey % 1500, p_size] AS ys
  FROM part), e AS (SELECT id, unnest(xs) AS a, ys FROM r), f AS (SELECT id, a, unnest(ys) AS b FROM e)
SELECT id, coalesce(bool_or(a <> b AND relation IN ('1-URGENT', '2-HIGH')), false) AS linked FROM f LEFT JOIN rel ON lo = least(a, b) AND hi = greatest(a, b) GROUP BY id""")
def any_pairing(t):
    rel = t.orders.select(F.col("o_custkey").alias("a"), (F.col("o_orderkey") % 500).alias("b"), F.col("o_orderpriority").alias("relation"), F.col("o_orderkey").alias("ord"))
    p = F.col("p_partkey")
    rows = t.part.select(p.alias("id"), F.array(p % 500, p % 41).alias("xs"), F.array(p % 1500, F.col("p_size").cast("long")).alias("ys"))
    return match.any_pairing(rows, rel, ["1-URGENT", "2-HIGH"])


@query("""WITH c AS (SELECT n_name AS construction, r_name AS domain
  FROM nation, region), o AS (SELECT n_name AS construction, r_name AS domain, 'selected' AS s FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT c.*, coalesce(s, CASE WHEN n_nationkey % 2 = 0 THEN 'contract_only' END, 'undeclared') AS status,
  CASE WHEN s IS NOT NULL THEN 'override' ELSE 'default' END AS rule FROM c LEFT JOIN o USING (construction, domain)
  JOIN nation ON n_name = construction""")
def coverage_matrix(t):
    named = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    own = named.select(F.col("n_name").alias("construction"), F.col("r_name").alias("domain"), F.lit("selected").alias("status"))
    default = t.nation.filter("n_nationkey % 2 = 0").select(F.col("n_name").alias("construction"), F.lit(None).cast("string").alias("domain"), F.lit("contract_only").alias("status"))
    return match.coverage_matrix(t.nation.select(F.col("n_name").alias("construction")), t.region.select(F.col("r_name").alias("domain")), own.unionByName(default))


@query("""WITH f AS (SELECT o_custkey AS stem, CASE o_orderstatus WHEN 'F' THEN 'csv' WHEN 'O' THEN 'c3d' ELSE 'txt' END AS ext FROM orders)
SELECT stem, array_to_string(list_sort(list(ext)), ',') AS found,
  CASE WHEN list_sort(list(ext)) = ['c3d', 'csv'] THEN 'complete' WHEN NOT (list_contains(list(ext), 'csv') AND list_contains(list(ext), 'c3d')) THEN 'missing' ELSE 'unexpected' END AS status
  FROM f GROUP BY stem""")
def pair_files(t):
    s = F.col("o_orderstatus")
    return match.pair_files(t.orders.select(F.col("o_custkey").alias("stem"), F.when(s == "F", "csv").when(s == "O", "c3d").otherwise("txt").alias("ext")), ["csv", "c3d"])


GLOSSES = """g AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 8 < 4 THEN 'Key no ' || o_orderkey ELSE 'k' || o_orderkey END AS label,
  'the ' || CASE WHEN (o_orderkey + d) % 8 < 4 THEN 'key no. ' ELSE 'K' END || (o_orderkey + d) || ' of ' || o_orderstatus AS gloss FROM (SELECT *,
  CASE WHEN o_orderkey % 4 < 2 THEN 2 ELSE -2 END AS d FROM orders)
  UNION ALL SELECT -o_orderkey, 'the', 'the order ' || o_orderstatus FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey > 0)"""


def glosses(t):
    """Orders with labels of one word or three that name each other, and as many with the commonest word as their label."""
    k = F.col("o_orderkey")
    other = k + F.when(k % 4 < 2, 2).otherwise(-2)
    label = F.concat(F.when(k % 8 < 4, "Key no ").otherwise("k"), k.cast("string"))
    gloss = F.concat(F.lit("the "), F.when(other % 8 < 4, "key no. ").otherwise("K"), other.cast("string"), F.lit(" of "), "o_orderstatus")
    common = t.orders.filter((k % 3 == 0) & (k > 0)).select((-k).alias("id"), F.lit("the").alias("label"), F.concat(F.lit("the order "), "o_orderstatus").alias("gloss"))
    return t.orders.select(k.alias("id"), label.alias("label"), gloss.alias("gloss")).unionByName(common)


@query(f"""WITH {GLOSSES}, w AS (SELECT id, trim(regexp_replace(lower(label), '[^a-z0-9_]+', ' ', 'g')) AS name, trim(regexp_replace(lower(gloss), '[^a-z0-9_]+', ' ', 'g')) AS said
  FROM g), c AS (SELECT name, said, min(id) AS id, max(id) AS last FROM w WHERE name <> '' AND said <> '' GROUP BY name, said),
s AS (SELECT id, name, said, unnest(range(1, len(said) + 1)) AS i FROM (SELECT id, name, string_split(said, ' ') AS said FROM c)),
p AS (SELECT id, name, said, i, unnest(range(i, least(len(said), i + (SELECT max(len(string_split(name, ' '))) FROM c) - 1) + 1)) AS j FROM s)
SELECT DISTINCT x.id AS a, y.id AS b, 'mutual' AS kind FROM p x JOIN c y ON y.name = array_to_string(x.said[x.i:x.j], ' ') AND x.id < y.id WHERE contains(' ' || y.said || ' ', ' ' || x.name || ' ')
UNION ALL SELECT c.id, w.id, CASE WHEN contains(' ' || said || ' ', ' ' || name || ' ') THEN 'mutual_copy' ELSE 'copy' END FROM w JOIN c USING (name, said) WHERE w.id <> c.id
UNION ALL SELECT a, id, 'equal' FROM (SELECT id, min(id) OVER (PARTITION BY gloss) AS a FROM g) WHERE id <> a""")
def mirror_pairs(t):
    return match.mirror_pairs(glosses(t))


@query(f"WITH {GLOSSES} SELECT id, min(id) OVER (PARTITION BY gloss) AS group_id, count(*) OVER (PARTITION BY gloss) AS size FROM g QUALIFY count(*) OVER (PARTITION BY gloss) > 1")
def equal_glosses(t):
    return match.equal_glosses(glosses(t))


@query("""WITH m AS (SELECT 'p' || l_orderkey || CASE WHEN l_linenumber % 5 = 0 THEN ':X' ELSE ':ARG' END || l_linenumber AS s, l_partkey AS role, (l_extendedprice, l_partkey) AS ord
  FROM lineitem)
SELECT regexp_extract(s, '^(.*):ARG([0-9]+)$', 1) AS predicate_id, CAST(regexp_extract(s, '^(.*):ARG([0-9]+)$', 2) AS INTEGER) AS arg, arg_max(role, ord) AS role
  FROM m WHERE regexp_matches(s, ':ARG[0-9]+$') GROUP BY 1, 2""")
def positional_roles(t):
    n = F.col("l_linenumber")
    s = F.concat(F.lit("p"), F.col("l_orderkey").cast("string"), F.when(n % 5 == 0, ":X").otherwise(":ARG"), n.cast("string"))
    return match.positional_roles(t.lineitem.select(s.alias("source_id"), F.col("l_partkey").alias("role"), F.struct("l_extendedprice", "l_partkey").alias("ord")))


@query("""SELECT p_partkey AS schema_id, p_brand AS consumer_role, p_size % 7 AS local_role, p_size % 3 AS expected_role,
  CASE WHEN p_size % 7 IN (0, 1, 2, 4, 5) THEN CASE WHEN p_size % 7 <> 2 THEN (p_size % 7) % 3 END END AS grounded_role,
CASE WHEN p_size % 7 NOT IN (0, 1, 2, 4, 5) THEN 'unknown_local_role' WHEN p_size % 7 = 2 THEN 'ungrounded' WHEN (p_size % 7) % 3 <> p_size % 3 THEN 'mismatch' ELSE 'resolved' END AS status
  FROM part""")
def consumer_profile_resolve(t):
    size = F.col("p_size")
    profile = t.part.select(F.col("p_partkey").alias("schema_id"), F.col("p_brand").alias("consumer_role"), (size % 7).alias("local_role"), (size % 3).alias("expected_role"))
    local = t.part.select(F.col("p_partkey").alias("schema_id"), F.explode(F.array(*[F.lit(x) for x in (0, 1, 2, 4, 5)])).alias("local_role")).withColumn("grounded_role", F.when(F.col("local_role") != 2, F.col("local_role") % 3))
    return match.resolve_profile(profile, local)


@query("SELECT DISTINCT o_orderpriority AS path FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < -900)")
def prune_source_files(t):
    return match.needed_files(t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("path")), t.customer.filter("c_acctbal < -900").select(F.col("c_custkey").alias("id")))


@query("""WITH s AS (SELECT DISTINCT l_orderkey AS id, 'ARG' || lpad(CAST(l_linenumber AS VARCHAR), 2, '0') AS role, CAST(l_linenumber AS VARCHAR) AS arg FROM lineitem),
h AS (SELECT l_orderkey AS id, CAST(l_linenumber AS VARCHAR) AS arg, count(*) AS n, min(l_partkey) AS d FROM lineitem WHERE l_quantity < 30 GROUP BY 1, 2)
SELECT id, role, arg, CASE WHEN n = 1 THEN CAST(d AS VARCHAR) END AS description,
  CASE WHEN n IS NULL THEN 'not_supplied' WHEN n = 1 THEN 'exact' ELSE 'conflicting' END AS status FROM s LEFT JOIN h USING (id, arg)""")
def resolve_argument_evidence(t):
    k, n = F.col("l_orderkey").alias("id"), F.col("l_linenumber")
    slots = t.lineitem.select(k, F.concat(F.lit("ARG"), F.lpad(n.cast("string"), 2, "0")).alias("role")).distinct()
    return match.argument_evidence(slots, t.lineitem.filter("l_quantity < 30").select(k, n.alias("number"), F.col("l_partkey").cast("string").alias("description"), F.col("l_partkey").alias("ord")))


@query("""WITH b AS (SELECT doc_id, source, n_chars % 97 AS v FROM documents), o AS (SELECT doc_id, n_chars % 97 + doc_id % 3 AS v FROM documents WHERE doc_id % 4 <> 0)
SELECT doc_id, abs(b.v - o.v) AS drift, (b.v > 48) <> (o.v > 48) AS flipped FROM b JOIN o USING (doc_id)""")
def compare_runs(t):
    v = F.col("n_chars") % 97
    run = lambda v: t.documents.select("doc_id", v.alias("v"), (v > 48).alias("p"))
    return match.compare_runs(run(v), run(v + F.col("doc_id") % 3).filter("doc_id % 4 <> 0"), ["doc_id"], "v", "p")


@query(f"""WITH {DONORS}, {SOURCES} SELECT family, normal_id, 'left' AS side FROM (SELECT DISTINCT family, normal_id FROM donors
  WHERE normal_id IS NOT NULL EXCEPT SELECT family, source_id FROM sources)
UNION ALL SELECT family, source_id, 'right' FROM (SELECT family, source_id FROM sources EXCEPT SELECT family, normal_id FROM donors)""")
def population_equal(t):
    key = lambda df: df.select(F.struct("family", "normal_id").alias("k"))
    out = checks.population_difference(key(donors(t).filter("normal_id is not null")), key(sources(t).withColumnRenamed("source_id", "normal_id")), "k")
    return out.select("k.family", "k.normal_id", "side")


@query("""SELECT c_custkey, code FROM (SELECT c_custkey, unnest([CASE WHEN c_acctbal < 0 THEN 'NEGATIVE' END,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'SEGMENT' END, CASE WHEN c_acctbal / 10000.0 NOT BETWEEN 0 AND 1 THEN 'CONFIDENCE' END]) AS code
  FROM customer) WHERE code IS NOT NULL""")
def validate_fields(t):
    return checks.field_violations(t.customer, "c_custkey", {"NEGATIVE": F.col("c_acctbal") < 0, "SEGMENT": F.col("c_mktsegment") == "BUILDING", "CONFIDENCE": checks.no_confidence(F.col("c_acctbal") / 10000)})


RECORDS = """rec AS (SELECT l_orderkey * 10 + l_linenumber AS id, ['predicate_type', 'role_slot', 'entity_type', 'hierarchy_edge'][l_orderkey % 4 + 1] AS kind, ['derived_from', 'positional_role', 'typed_by', 'subtype_of', 'candidate_alignment'][CASE WHEN l_partkey % 7 = 0 THEN l_suppkey % 5 WHEN l_orderkey % 4 = 0 AND l_suppkey % 2 = 0 THEN 4 ELSE l_orderkey % 4 END + 1] AS relation,
  ['donor', 'propbank', 'framenet_candidate', 'sumo_types', 'another'][l_partkey % 5 + 1] AS source, CASE WHEN l_linenumber = 2 THEN 'm' END AS ref,
  CASE WHEN l_linenumber IN (2, 3) AND l_partkey % 3 > 0 THEN 'unknown' END AS scope, CASE WHEN l_linenumber = 4 THEN 0.5 END AS confidence
  FROM lineitem)"""


@query(f"""WITH {RECORDS}, c AS (SELECT id,
  CASE WHEN NOT coalesce(kind || '|' || relation IN ('predicate_type|derived_from', 'predicate_type|candidate_alignment', 'role_slot|positional_role', 'entity_type|typed_by', 'hierarchy_edge|subtype_of'), false) THEN 'RELATION_OF_KIND' WHEN (ref IS NULL) <> (scope IS NULL) THEN 'METHOD_WITHOUT_SCOPE' WHEN ref IS NOT NULL AND relation <> 'candidate_alignment' THEN 'METHOD_OF_NO_CANDIDATE'
  WHEN confidence IS NOT NULL AND relation <> 'candidate_alignment' THEN 'CONFIDENCE_OF_NO_CANDIDATE' WHEN source = 'another' THEN 'UNKNOWN_SOURCE' WHEN NOT (CASE source WHEN 'framenet_candidate' THEN relation = 'candidate_alignment' WHEN 'sumo_types' THEN kind IN ('entity_type', 'hierarchy_edge') ELSE relation IN ('derived_from', 'positional_role') END) THEN 'RELATION_OF_SOURCE' END AS code
  FROM rec) SELECT id, code FROM c WHERE code IS NOT NULL""")
def legal_combination(t):
    o, p, s, n = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    pick = lambda names, at: F.element_at(F.array(*[F.lit(x) for x in names]), (at + 1).cast("int"))
    relation = F.when(p % 7 == 0, s % 5).when((o % 4 == 0) & (s % 2 == 0), 4).otherwise(o % 4)
    records = t.lineitem.select(
        (o * 10 + n).alias("id"),
        pick(["predicate_type", "role_slot", "entity_type", "hierarchy_edge"], o % 4).alias("canonical_kind"),
        pick(["derived_from", "positional_role", "typed_by", "subtype_of", "candidate_alignment"], relation).alias("relation"),
        pick(["donor", "propbank", "framenet_candidate", "sumo_types", "another"], p % 5).alias("source_key"),
        F.when(n == 2, "m").alias("method_ref"),
        F.when(n.isin(2, 3) & (p % 3 > 0), "unknown").alias("method_scope"),
        F.when(n == 4, 0.5).alias("confidence"),
    )
    return checks.mapping_violations(records, "id")


@query("""SELECT p_partkey, 'lc:' || lower(trim(p_name)) AS predicate_id, 'lc.role.' || lower(trim(p_type)) AS role_id, 'lc.role.relation_arg' || p_size AS position_id, 'lc:sumo_type.' || lower(p_brand) AS type_id,
'id_' || substr(sha256(concat_ws(chr(0), CAST(p_partkey AS VARCHAR), p_brand)), 1, 24) AS stable_id, 'j_' || sha256('{"brand":"' || p_brand || '","size":"' || p_size || '"}') AS json_id
  FROM part""")
def namespace_ids(t):
    c = F.col
    return t.part.select("p_partkey", ids.predicate_id(c("p_name")).alias("predicate_id"), ids.role_id(c("p_type")).alias("role_id"), ids.positional_role_id(c("p_size")).alias("position_id"), ids.type_id(F.concat(F.lit("sumo:"), "p_brand")).alias("type_id"), ids.stable_id("id_", c("p_partkey"), c("p_brand")).alias("stable_id"), ids.json_id("j_", size=c("p_size"), brand=c("p_brand")).alias("json_id"))


@query("""SELECT count(*) AS rows, count(DISTINCT o_custkey) AS customers FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def exclude_existing(t):
    out = match.exclude_existing(t.orders.withColumnRenamed("o_custkey", "k"), t.customer.filter("c_acctbal > 0").withColumnRenamed("c_custkey", "k"), ["k"])
    return out.agg(F.count("*").alias("rows"), F.count_distinct("k").alias("customers"))


@query("SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0 AND c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderkey % 5 = 0)")
def split_disjoint(t):
    return checks.overlapping_groups(t.customer.filter("c_custkey % 2 = 0"), t.orders.filter("o_orderkey % 5 = 0").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 6 = 0 EXCEPT ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 4 = 0")
def additive_over(t):
    o = t.orders.select("o_orderkey", "o_custkey")
    return checks.not_additive(o.filter("o_orderkey % 6 = 0"), o.filter("o_orderkey % 4 = 0"))


@query("""WITH l AS (SELECT o_orderkey AS k, o_custkey AS a, o_orderkey % 100 AS b FROM orders), r AS (SELECT o_orderkey AS k, o_orderkey % 100 AS a,
  CASE WHEN o_orderkey % 8 = 0 THEN -1 ELSE o_custkey END AS b FROM orders WHERE o_orderkey % 7 <> 0)
SELECT k, CASE WHEN r.k IS NULL THEN 'no_incoming' ELSE 'not_swapped' END AS status FROM l LEFT JOIN r USING (k) WHERE r.k IS NULL OR l.a <> r.b OR l.b <> r.a""")
def mirror_consistent(t):
    k = F.col("o_orderkey")
    out = t.orders.select(k.alias("k"), F.col("o_custkey").alias("a"), (k % 100).alias("b"))
    back = t.orders.filter("o_orderkey % 7 <> 0").select(k.alias("k"), (k % 100).alias("a"), F.when(k % 8 == 0, -1).otherwise(F.col("o_custkey")).alias("b"))
    return checks.mirror_violations(out, back, ["k"], "a", "b")


@query("""WITH e AS (SELECT o_orderkey AS relation_id, 'sub' AS "end", o_custkey AS id, 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS name
  FROM orders UNION ALL SELECT o_orderkey, 'super', o_orderkey % 1000,
  CASE WHEN o_orderkey % 3 = 0 THEN 'other' ELSE 'Customer#' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 9, '0') END FROM orders)
SELECT relation_id, "end", status FROM (SELECT e.*, CASE WHEN c_custkey IS NULL THEN 'missing' WHEN c_name IS DISTINCT
  FROM name THEN 'name_mismatch' END AS status FROM e LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 50 <> 0) ON c_custkey = id)
  WHERE status IS NOT NULL""")
def resolve_endpoints(t):
    name = lambda c: F.concat(F.lit("Customer#"), F.lpad(c.cast("string"), 9, "0"))
    k = F.col("o_orderkey")
    rel = t.orders.select(k.alias("relation_id"), F.col("o_custkey").alias("sub_id"), name(F.col("o_custkey")).alias("sub_name"), (k % 1000).alias("super_id"), F.when(k % 3 == 0, "other").otherwise(name(k % 1000)).alias("super_name"))
    return match.resolve_endpoints(rel, t.customer.filter("c_custkey % 50 <> 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))


@query(f"""WITH {MAPPINGS}, v AS (SELECT source_key, CASE WHEN identity_state = 'exact' AND length(source_id) % 3 = 0 THEN 'verified' ELSE state END AS state FROM cross_)
SELECT source_key, count(*) AS rows, CAST(count_if(state = 'verified') AS BIGINT) AS eligible, CAST(count_if(state <> 'verified') AS BIGINT) AS withheld FROM v GROUP BY 1""")
def eligible_view(t):
    df = cross(t).withColumn("state", F.when((F.col("identity_state") == "exact") & (F.length("source_id") % 3 == 0), "verified").otherwise(F.col("state")))
    return match.view_receipt(df)


@query("""SELECT 'documents' AS source, count(*) AS files, CAST(count_if(n_chars % 9 <> 0) AS BIGINT) AS parsed, CAST(count_if(doc_id % 10 = 0 OR n_chars % 9 = 0) AS BIGINT) AS issues, CAST(count_if(doc_id % 50 = 0) AS BIGINT) AS repairs, count_if(doc_id % 10 = 0 AND n_chars % 9 <> 0) = 0 AS complete
  FROM documents
UNION ALL SELECT 'pages', count(*), CAST(count_if(page_id % 4 > 0) AS BIGINT), CAST(count_if(page_id % 4 = 0) AS BIGINT), 0, true FROM pages""")
def source_coverage(t):
    docs = t.documents.select(F.col("doc_id").alias("path"), (F.col("n_chars") % 9 != 0).alias("parsed"))
    pages = t.pages.select(F.col("page_id").alias("path"), (F.col("page_id") % 4 > 0).alias("parsed"))
    repaired = t.documents.filter("doc_id % 50 = 0").select(F.lit("documents").alias("source"), F.col("doc_id").alias("path"))
    return M.source_coverage({"documents": (docs, docs.filter("path % 10 = 0 or not parsed")), "pages": (pages, pages.filter("not parsed"))}, repaired)


@query("""WITH a AS (SELECT l_orderkey AS path, l_linenumber AS idx, l_partkey AS child, l_suppkey AS parent
  FROM lineitem), t AS (SELECT p_partkey AS term FROM part WHERE p_partkey % 97 <> 0)
SELECT 'line' AS asset, 'UNKNOWN_TERM' AS code, CAST(d AS VARCHAR) AS detail FROM (SELECT child AS d FROM a UNION SELECT parent FROM a) WHERE d NOT IN (SELECT term FROM t)
UNION ALL SELECT 'line', 'UNKNOWN_MODULE', CAST(path AS VARCHAR) FROM (SELECT DISTINCT path FROM a) WHERE path NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 101 <> 0)
UNION ALL SELECT 'line', 'DUPLICATE_AXIOM', path || '#' || idx FROM a GROUP BY path, idx HAVING count(*) > 1""")
def projection_closed(t):
    axioms = t.lineitem.select(F.col("l_orderkey").alias("path"), F.col("l_linenumber").alias("idx"), F.col("l_partkey").alias("child"), F.col("l_suppkey").alias("parent"))
    return checks.projection_closure({"line": (axioms, ["child", "parent"])}, t.part.filter("p_partkey % 97 <> 0").select(F.col("p_partkey").alias("term")), t.orders.filter("o_orderkey % 101 <> 0").select(F.col("o_orderkey").alias("path")))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity < 10 INTERSECT SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity > 40")
def common_keys(t):
    return checks.common_keys(t.lineitem.filter("l_quantity < 10"), t.lineitem.filter("l_quantity > 40"), ["l_orderkey", "l_linenumber"])


@query("""WITH e AS (SELECT l_orderkey AS relation_id, l_linenumber AS fe_relation_id, l_partkey AS sub_fe_id, l_suppkey * 7 AS super_fe_id
  FROM lineitem), r AS (SELECT o_orderkey AS relation_id, o_custkey % 25 AS sub_id, o_orderkey % 25 AS super_id FROM orders
  WHERE o_orderkey % 11 > 0), f AS (SELECT p_partkey AS fe_id, p_partkey % 25 AS frame_id FROM part WHERE p_partkey % 9 > 0),
x AS (SELECT e.relation_id, fe_relation_id, r.relation_id IS NOT NULL AS known, 'sub' AS "end", sub_fe_id AS fe_id, sub_id AS wanted FROM e LEFT
  JOIN r USING (relation_id) UNION ALL SELECT e.relation_id, fe_relation_id, r.relation_id IS NOT NULL, 'super', super_fe_id, super_id FROM e LEFT
  JOIN r USING (relation_id))
SELECT relation_id, fe_relation_id, "end",
  CASE WHEN NOT known THEN 'missing_relation' WHEN frame_id IS NULL THEN 'missing' ELSE 'wrong_frame' END AS status FROM x LEFT JOIN f USING (fe_id)
  WHERE NOT known OR frame_id IS NULL OR frame_id <> wanted""")
def resolve_element_endpoints(t):
    k = F.col("o_orderkey")
    ends = t.lineitem.select(F.col("l_orderkey").alias("relation_id"), F.col("l_linenumber").alias("fe_relation_id"), F.col("l_partkey").alias("sub_fe_id"), (F.col("l_suppkey") * 7).alias("super_fe_id"))
    relations = t.orders.filter(k % 11 > 0).select(k.alias("relation_id"), (F.col("o_custkey") % 25).alias("sub_id"), (k % 25).alias("super_id"))
    elements = t.part.filter("p_partkey % 9 > 0").select(F.col("p_partkey").alias("fe_id"), (F.col("p_partkey") % 25).alias("frame_id"))
    return match.resolve_element_endpoints(ends, relations, elements)


@query("""WITH n AS (SELECT o_custkey AS participant, o_orderstatus AS ext, count(*) AS n FROM orders
  GROUP BY 1, 2), w AS (SELECT c_custkey AS participant FROM customer
  WHERE c_custkey % 3 > 0) SELECT coalesce(n.participant, w.participant) AS participant, ext, coalesce(n, 0) AS n,
  CASE WHEN ext IS NULL THEN 'missing' WHEN w.participant IS NULL THEN 'unexpected' ELSE 'expected' END AS status FROM n FULL
  JOIN w ON w.participant = n.participant""")
def participant_counts(t):
    files = t.orders.select(F.col("o_custkey").alias("participant"), F.col("o_orderstatus").alias("ext"))
    return match.participant_counts(files, t.customer.filter("c_custkey % 3 > 0").select(F.col("c_custkey").alias("participant")))
