"""Record checks, bindings, inspections and scalar rules over the tables."""

from pyspark.sql import functions as F

from crosslink.functions import ids, texts, values
from crosslink.operators import checks, graph, match, rules
from crosslink.plans.base import query
from crosslink.plans.graphs import CLOSURE, cyclic, edges
from crosslink.sources import files

SLOTS = f"""{CLOSURE}, sl AS (SELECT DISTINCT o_orderpriority AS predicate, 'L' || (o_custkey % 10) AS label,
  CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority || (o_custkey % 10) END AS role,
  CASE WHEN o_custkey % 3 = 0 THEN 'n' || (o_custkey % 25) WHEN o_custkey % 3 = 1 THEN 'r' || (o_custkey % 6) END AS type FROM orders),
re AS (SELECT o_orderpriority || i AS role, i % 4 > 0 AS case_role FROM (SELECT DISTINCT o_orderpriority
  FROM orders), (SELECT unnest(range(8)) AS i)), ty AS (SELECT DISTINCT node AS type FROM closure),
co AS (SELECT DISTINCT o_orderpriority || (o_custkey % 10) AS role, 'r' || (o_custkey % 2) AS required_type FROM orders WHERE o_custkey % 10 < 6),
au AS (SELECT sl.*, CASE WHEN sl.role IS NULL THEN 'unmapped' WHEN case_role IS NULL THEN 'missing_current_source' WHEN case_role THEN 'exact_case_role' ELSE 'exact_non_case_relation' END AS role_status,
  CASE WHEN sl.type IS NULL THEN 'unmapped' WHEN ty.type IS NULL THEN 'missing_current_source' ELSE 'exact_current_source' END AS type_status FROM sl
  LEFT JOIN re USING (role) LEFT JOIN ty ON ty.type = sl.type),
tr AS (SELECT s.role, s.type, CASE WHEN count(required_type) = 0 THEN 'no_direct_constraint' WHEN count(required_type) = 1 AND max(required_type) = s.type THEN 'direct_match' WHEN bool_and((s.type, required_type) IN (SELECT (node, ancestor)
  FROM closure)) THEN 'compatible_donor_subtype' WHEN bool_and((required_type, s.type) IN (SELECT (node, ancestor)
  FROM closure)) THEN 'incompatible_donor_supertype' ELSE 'incomparable_types' END AS status
  FROM (SELECT DISTINCT role, type FROM au WHERE role_status = 'exact_case_role' AND type_status = 'exact_current_source') s LEFT JOIN co USING (role) GROUP BY 1, 2)"""


@query(f"""{SLOTS} SELECT predicate, label, role, au.type, role_status, type_status,
  CASE WHEN role_status = 'exact_case_role' AND type_status = 'exact_current_source' THEN status ELSE 'not_applicable' END AS constraint_status
  FROM au LEFT JOIN tr USING (role, type)""")
def audit_roles(t):
    c, ten = F.col("o_custkey"), (F.col("o_custkey") % 10).cast("string")
    named = F.concat("o_orderpriority", ten)
    kind = F.when(c % 3 == 0, F.concat(F.lit("n"), (c % 25).cast("string"))).when(c % 3 == 1, F.concat(F.lit("r"), (c % 6).cast("string")))
    slots = t.orders.select(F.col("o_orderpriority").alias("predicate"), F.concat(F.lit("L"), ten).alias("label"), F.when(F.col("o_orderkey") % 4 > 0, named).alias("role"), kind.alias("type")).distinct()
    relations = t.orders.select("o_orderpriority").distinct().select("o_orderpriority", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("i")).select(F.concat("o_orderpriority", F.col("i").cast("string")).alias("relation"), (F.col("i") % 4 > 0).alias("is_case_role"))
    closure = graph.ancestor_closure(edges(t).unionByName(cyclic(t)))
    constraints = t.orders.filter(c % 10 < 6).select(named.alias("relation"), F.concat(F.lit("r"), (c % 2).cast("string")).alias("required_type"))
    return match.audit_roles(slots, relations, closure.select(F.col("node").alias("type")), constraints, closure)


@query("""WITH a AS (SELECT DISTINCT l_suppkey AS p, 'L' || l_linenumber AS label FROM lineitem
  WHERE l_linenumber < 6), r AS (SELECT 'L' || n AS label, 'role' || n AS role_id FROM (SELECT DISTINCT l_linenumber AS n FROM lineitem
  WHERE l_linenumber % 2 = 0))
SELECT c_custkey AS case_id, c_custkey % 50 AS predicate_id, 'L' || (c_custkey % 9) AS label, CASE WHEN p IS NOT NULL THEN role_id END AS role_id,
  CASE WHEN p IS NULL THEN 'missing_slot' WHEN role_id IS NULL THEN 'missing_role' ELSE 'bound' END AS status FROM customer LEFT
  JOIN a ON p = c_custkey % 50 AND a.label = 'L' || (c_custkey % 9) LEFT JOIN r ON r.label = 'L' || (c_custkey % 9)""")
def bind_reviews(t):
    k = F.col("c_custkey")
    label = lambda c: F.concat(F.lit("L"), c.cast("string")).alias("label")
    slots = t.lineitem.filter("l_linenumber < 6").select(F.col("l_suppkey").alias("predicate_id"), label(F.col("l_linenumber")))
    roles = t.lineitem.filter("l_linenumber % 2 = 0").select(label(F.col("l_linenumber")), F.concat(F.lit("role"), F.col("l_linenumber").cast("string")).alias("role_id")).distinct()
    return match.bind_reviews(t.customer.select(k.alias("case_id"), (k % 50).alias("predicate_id"), label(k % 9)), slots, roles)


@query("""WITH r AS (SELECT l_partkey AS p, string_agg(l_orderkey * 10 + l_linenumber || ':' || l_returnflag, ','
  ORDER BY l_orderkey * 10 + l_linenumber, l_returnflag) AS roles FROM lineitem GROUP BY 1), m AS (SELECT p, string_agg(f || '=' || ids, ';'
  ORDER BY f) AS mappings FROM (SELECT l_partkey AS p, l_shipmode AS f, string_agg(DISTINCT CAST(l_suppkey AS VARCHAR), ','
  ORDER BY CAST(l_suppkey AS VARCHAR)) AS ids FROM lineitem GROUP BY 1, 2) GROUP BY 1)
SELECT p_partkey AS predicate_id, p_name AS label, coalesce(roles, '') AS roles, coalesce(mappings, '') AS mappings FROM part LEFT
  JOIN r ON r.p = p_partkey LEFT JOIN m ON m.p = p_partkey""".replace("l_shipmode", "l_linestatus"))
def inspect_predicate(t):
    order = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    roles = t.lineitem.select(F.col("l_partkey").alias("predicate_id"), order.alias("ord"), F.col("l_returnflag").alias("role"), F.lit(True).alias("required"))
    maps = t.lineitem.select(F.col("l_partkey").alias("predicate_id"), F.col("l_linestatus").alias("family"), F.col("l_suppkey").cast("string").alias("source_id"))
    out = match.inspect_predicates(t.part.select(F.col("p_partkey").alias("predicate_id"), F.col("p_name").alias("label")), roles, maps)
    shown = F.array_join(F.transform("roles", lambda r: F.concat_ws(":", r["ord"].cast("string"), r["role"])), ",")
    mapped = F.array_join(F.transform(F.array_sort(F.map_entries("mappings")), lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))), ";")
    return out.select("predicate_id", "label", F.coalesce(shown, F.lit("")).alias("roles"), F.coalesce(mapped, F.lit("")).alias("mappings"))


@query("""SELECT 'c' || o_custkey AS canonical_id, o_orderpriority AS source_key, o_orderkey AS source_id, d AS source_description,
  CASE WHEN d IS NULL THEN 'undeclared_source' ELSE 'declared' END AS status FROM orders LEFT
  JOIN (SELECT DISTINCT o_orderpriority AS k, upper(o_orderpriority) AS d FROM orders WHERE o_orderpriority < '4') ON k = o_orderpriority""")
def inspect_lineage(t):
    rows = t.orders.select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("canonical_id"), F.col("o_orderpriority").alias("source_key"), F.col("o_orderkey").alias("source_id"))
    sources = t.orders.filter("o_orderpriority < '4'").select(F.col("o_orderpriority").alias("source_key"), F.upper("o_orderpriority").alias("description")).distinct()
    return match.inspect_lineage(rows, sources)


@query("""WITH x AS (SELECT l_orderkey * 10 + l_linenumber AS case_id, 'p' || l_partkey % 20 AS from_id, 'r' || l_linenumber AS from_role, 'p' || l_suppkey % 20 AS to_id, 'r' || (l_linenumber + 1) AS to_role
  FROM lineitem), s AS (SELECT 'p' || i AS p, 'r' || j AS r FROM (SELECT unnest(range(20)) AS i), (SELECT unnest(range(1, 8)) AS j)
  WHERE (i + j) % 5 > 0)
SELECT x.*, CASE WHEN a.p IS NULL THEN 'missing_source_role' WHEN b.p IS NULL THEN 'missing_target_role' WHEN (CAST(substr(from_id, 2) AS INTEGER) + CAST(substr(to_id, 2) AS INTEGER)) % 3 > 0 OR from_role > 'r5' THEN 'missing_correspondence' ELSE 'bound' END AS status
  FROM x LEFT JOIN s a ON a.p = from_id AND a.r = from_role LEFT JOIN s b ON b.p = to_id AND b.r = to_role""")
def bind_transform_evidence(t):
    n = F.col("l_linenumber")
    tag = lambda letter, c: F.concat(F.lit(letter), c.cast("string"))
    rows = t.lineitem.select((F.col("l_orderkey") * 10 + n).alias("case_id"), tag("p", F.col("l_partkey") % 20).alias("from_id"), tag("r", n).alias("from_role"), tag("p", F.col("l_suppkey") % 20).alias("to_id"), tag("r", n + 1).alias("to_role"))
    grid = t.spark.range(20).select(F.col("id").alias("i"), F.explode(F.sequence(F.lit(1), F.lit(7))).alias("j"))
    slots = grid.filter("(i + j) % 5 > 0").select(tag("p", F.col("i")).alias("predicate_id"), tag("r", F.col("j")).alias("role"))
    pairs = t.spark.range(20).select(F.col("id").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(19))).alias("b")).filter("(a + b) % 3 = 0").select("a", "b", F.explode(F.sequence(F.lit(1), F.lit(5))).alias("j"))
    known = pairs.select(tag("p", F.col("a")).alias("from_id"), tag("r", F.col("j")).alias("from_role"), tag("p", F.col("b")).alias("to_id"), tag("r", F.col("j") + 1).alias("to_role"))
    return match.transform_evidence(rows, slots, known)


@query("SELECT DISTINCT url AS path FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)")
def excluded_paths(t):
    every = t.pages.select("page_id", F.col("url").alias("path"))
    return files.excluded_paths(every, every.filter("page_id % 3 = 0"))


@query("""SELECT o_orderkey, 'v' || (o_custkey % 8) AS version FROM orders WHERE o_custkey % 8 IN (7, 3, 1, 0)""")
def union_lineage(t):
    """Orders belong to versions; version n extends n // 2."""
    k = F.col("o_custkey") % 8
    version = F.concat(F.lit("v"), k.cast("string")).alias("version")
    up = F.when(k > 0, F.concat(F.lit("v"), F.floor(k / 2).cast("string"))).alias("extends")
    lineage = graph.version_lineage(t.orders.select(version, up).distinct())
    return graph.union_lineage(t.orders.select("o_orderkey", version), lineage, "v7")


@query("SELECT doc_id, sha1('blob ' || octet_length(encode(text)) || chr(0) || text) AS sha FROM documents")
def git_blob_sha(t):
    return t.documents.select("doc_id", ids.blob_sha(F.col("text")).alias("sha"))


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN a AND NOT b THEN 'static' WHEN b AND NOT a THEN 'dynamic' ELSE 'refused' END AS rule
  FROM (SELECT *, l_quantity < 30 AS a, coalesce(CASE WHEN l_returnflag <> 'N' THEN l_discount > 0.04 END, false) AS b FROM lineitem)""")
def predict_two_rules(t):
    moving = F.when(F.col("l_returnflag") != "N", F.col("l_discount") > 0.04)
    return t.lineitem.select("l_orderkey", "l_linenumber", values.two_rules(F.col("l_quantity") < 30, moving).alias("rule"))


@query("""SELECT o_custkey, len(list_distinct(ks)) = len(ks) AND ks = list_sort(ks) AS fine FROM (SELECT o_custkey, list(o_orderkey % 7 ORDER BY o_orderkey) AS ks FROM orders GROUP BY 1)""")
def sorted_unique(t):
    rows = t.orders.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey"))).alias("ks"))
    return rows.select("o_custkey", values.sorted_unique(F.transform("ks", lambda x: x["o_orderkey"] % 7)).alias("fine"))


@query(r"""WITH v AS (SELECT c_custkey AS k, md5(CAST(c_custkey AS VARCHAR)) AS h, (c_custkey % 12) || '.' || CASE WHEN c_custkey % 5 = 0 THEN '0' ELSE '' END || (c_custkey % 7) || '.3' || CASE WHEN c_custkey % 4 = 0 THEN '-rc.1' ELSE '' END AS v,
  CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE replace(c_name, '#', ':') END AS i FROM customer)
SELECT k, regexp_full_match(CASE WHEN k % 6 = 0 THEN upper(h) ELSE h END, '[0-9a-f]{32}') AS hex, regexp_full_match(v, '(0|[1-9][0-9]*)\.(0|[1-9][0-9]*)\.(0|[1-9][0-9]*)(-[0-9A-Za-z.-]+)?') AS version, regexp_full_match(i, '[A-Za-z][A-Za-z0-9_.:-]*') AS token
  FROM v""")
def valid_ids(t):
    k = F.col("c_custkey")
    h = F.md5(k.cast("string"))
    version = F.concat((k % 12).cast("string"), F.lit("."), F.when(k % 5 == 0, "0").otherwise(""), (k % 7).cast("string"), F.lit(".3"), F.when(k % 4 == 0, "-rc.1").otherwise(""))
    name = F.when(k % 3 == 0, F.col("c_name")).otherwise(F.replace("c_name", F.lit("#"), F.lit(":")))
    return t.customer.select(k.alias("k"), ids.is_hex(F.when(k % 6 == 0, F.upper(h)).otherwise(h), 32).alias("hex"), ids.is_version(version).alias("version"), ids.is_token(name).alias("token"))


@query("""SELECT event_id, CASE WHEN event_id % 4 < 2 THEN epoch(date_trunc('second', ts)) - CASE WHEN event_id % 4 = 1 THEN 7200 ELSE 0 END END AS seconds FROM events""")
def parse_utc_seconds(t):
    k = F.col("event_id") % 4
    text = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss")
    zone = F.when(k == 0, "Z").when(k == 1, "+02:00").when(k == 2, "").otherwise(".5Z")
    return t.events.select("event_id", F.unix_timestamp(ids.utc_seconds(F.concat(text, zone))).cast("double").alias("seconds"))


@query("""SELECT event_id, round(value - user_id / 10.0, 6) AS at, value - user_id / 10.0 >= -0.000001 AND value - user_id / 10.0 <= 60.000001 AS inside FROM events""")
def align_event_time(t):
    at = values.event_time(F.col("value"), F.col("user_id"), F.lit(10.0))
    return t.events.select("event_id", F.round(at, 6).alias("at"), values.in_trial(at, F.lit(60.0)).alias("inside"))


@query(r"""SELECT a.turn, a.conv_id, regexp_matches(a.text, '\b(one|two|three|first|second|third|1|2)\b|\bhalf\b', 'i') OR regexp_matches(b.text, '\b(one|two|three|first|second|third|1|2)\b|\bhalf\b', 'i') AS same
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1""")
def shortlist_by_shape(t):
    a, b = t.conversations.alias("a"), t.conversations.alias("b")
    both = a.join(b, (F.col("a.conv_id") == F.col("b.conv_id")) & (F.col("b.turn") == F.col("a.turn") + 1))
    return both.select("a.turn", "a.conv_id", texts.same_shape(F.col("a.text"), F.col("b.text")).alias("same"))


@query("""SELECT c_custkey, array_to_string(list_filter([CASE WHEN trim(x.k) <> '' THEN 'a=' || x.k END,
  CASE WHEN trim(x.s) NOT IN ('', 'unknown', 'none', 'n/a') THEN 'b=' || x.s END], lambda e: e IS NOT NULL), ',') AS roles FROM (SELECT c_custkey,
  CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE c_mktsegment END AS k, CASE c_custkey % 5 WHEN 0 THEN 'unknown' WHEN 1 THEN ' n/a' WHEN 2 THEN 'Unknown' ELSE c_name END AS s
  FROM customer) x""")
def drop_empty_roles(t):
    k = F.col("c_custkey")
    b = F.when(k % 5 == 0, "unknown").when(k % 5 == 1, " n/a").when(k % 5 == 2, "Unknown").otherwise(F.col("c_name"))
    left = texts.without_empty_roles(F.create_map(F.lit("a"), F.when(k % 3 == 0, " ").otherwise(F.col("c_mktsegment")), F.lit("b"), b))
    return t.customer.select("c_custkey", F.array_join(F.transform(F.array_sort(F.map_entries(left)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",").alias("roles"))


@query("""SELECT o_custkey, CASE WHEN count_if(o_orderstatus = 'P') > 0 THEN 'incomplete' WHEN count_if(o_orderpriority = '1-URGENT') > 0 THEN 'complete_with_repairs' ELSE 'complete' END AS status
  FROM orders GROUP BY 1""")
def completeness(t):
    n = lambda c: F.count_if(c)
    rows = t.orders.groupBy("o_custkey").agg(F.count("*").alias("parsed"), n(F.col("o_orderpriority") == "1-URGENT").alias("repaired"), n(F.col("o_orderstatus") == "P").alias("issues"))
    return rows.select("o_custkey", rules.completeness(F.col("parsed"), F.col("repaired"), F.col("issues")).alias("status"))


@query("""SELECT o_custkey, n, 'stored' AS side FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) WHERE o_custkey % 9 = 0
  UNION ALL SELECT o_custkey, count(*) + 1, 'recomputed' FROM orders WHERE o_custkey % 9 = 0 GROUP BY 1""")
def verify_replay(t):
    """A stored count by customer against a recomputation that counts one order twice for every ninth."""
    stored = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    again = t.orders.groupBy("o_custkey").agg((F.count("*") + (F.col("o_custkey") % 9 == 0).cast("int")).alias("n"))
    return checks.replay_difference(stored, again)


@query("SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity > 10 GROUP BY 1")
def non_empty_or_fail(t):
    return checks.non_empty(t.lineitem.filter("l_quantity > 10"), "lines").groupBy("l_returnflag").agg(F.count("*").alias("n"))


@query("""SELECT p_partkey AS repair_id FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)""")
def unused_repairs(t):
    """Parts as repairs; large lines as their applications."""
    applied = t.lineitem.filter("l_quantity > 45").select(F.col("l_partkey").alias("repair_id"))
    return rules.unused_repairs(t.part.select(F.col("p_partkey").alias("repair_id")), applied)
