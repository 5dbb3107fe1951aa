"""Closures, paths, lineages and type relations over order-to-region edges and a cyclic graph."""

from functools import reduce

from pyspark.sql import functions as F

from crosslink.operators import catalog, checks, graph, match
from crosslink.plans.base import query
from crosslink.scratch import remove_at_end, scratch, written
from crosslink.sources import packs

EDGES = """edges AS (SELECT 'c' || c_custkey AS child, 'n' || c_nationkey AS parent FROM customer UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation),
cyclic AS (SELECT 'p' || p_partkey AS child, 'p' || (p_partkey - p_partkey % 7 + (p_partkey % 7 + 1) % 7) AS parent FROM part)"""


def tag(letter, c):
    return F.concat(F.lit(letter), F.col(c).cast("string"))


def edges(t):
    return t.customer.select(tag("c", "c_custkey").alias("child"), tag("n", "c_nationkey").alias("parent")).unionByName(t.nation.select(tag("n", "n_nationkey").alias("child"), tag("r", "n_regionkey").alias("parent")))


def cyclic(t):
    """Parts in cycles of seven."""
    k = F.col("p_partkey")
    return t.part.select(tag("p", "p_partkey").alias("child"), F.concat(F.lit("p"), (k - k % 7 + (k % 7 + 1) % 7).cast("string")).alias("parent"))


CLOSURE = f"""WITH RECURSIVE {EDGES}, every AS (SELECT * FROM edges UNION ALL SELECT *
  FROM cyclic), closure AS (SELECT child AS node, child AS ancestor FROM every UNION SELECT parent, parent FROM every UNION SELECT node, parent
  FROM closure JOIN every ON child = ancestor)"""


@query(f"{CLOSURE} SELECT * FROM closure")
def ancestor_closure(t):
    return graph.ancestor_closure(edges(t).unionByName(cyclic(t)))


@query(f"{CLOSURE} SELECT * FROM closure")
def closure_delta(t):
    """The closure of two thirds of the customers' edges and the parts', stored, then kept up to date as the nations' and the other customers' edges come."""
    late = (F.substring("child", 1, 1) == "n") | (F.length("child") % 3 == 0)
    every = edges(t).unionByName(cyclic(t))
    stored = written(graph.ancestor_closure(every.filter(~late)), "closure")
    return stored.unionByName(graph.closure_delta(stored, every.filter(late)))


@query(f"""{CLOSURE}, seeds AS (SELECT 'c' || c_custkey AS id FROM customer UNION ALL SELECT child FROM cyclic UNION ALL SELECT 'lonely')
SELECT DISTINCT id, id NOT IN (SELECT node FROM closure) OR id IN (SELECT node FROM closure WHERE ancestor NOT IN (SELECT child FROM every)) AS reached FROM seeds""")
def reaches_root(t):
    every = edges(t).unionByName(cyclic(t))
    seeds = t.customer.select(tag("c", "c_custkey").alias("id")).unionByName(cyclic(t).select(F.col("child").alias("id"))).unionByName(t.spark.range(1).select(F.lit("lonely").alias("id")))
    return graph.reaches_root(every, seeds)


DAG = """dag AS (SELECT * FROM (SELECT p_partkey AS child, p_partkey + 1 + p_size % 3 AS parent FROM part UNION SELECT p_partkey, p_partkey + 2 FROM part) WHERE child // 12 = parent // 12)"""


@query(f"""WITH RECURSIVE {DAG}, starts AS (SELECT DISTINCT child AS start FROM dag
  WHERE child % 4 = 0), walk AS (SELECT start, start AS cur, 0 AS length, CAST(start AS VARCHAR) AS path FROM starts
  UNION ALL SELECT start, parent, length + 1, path || '>' || parent FROM walk JOIN dag ON child = cur),
hit AS (SELECT start, cur, length, path FROM walk WHERE cur = start + 5), best AS (SELECT start, min(length) AS length FROM hit GROUP BY 1)
SELECT start, start + 5 AS target, CAST(length AS INTEGER) AS length, count(*) AS n_paths, CASE WHEN count(*) = 1 THEN min(path) END AS path FROM hit
  JOIN best USING (start, length) GROUP BY start, length""")
def unique_shortest_path(t):
    """Parts as nodes of graphs of twelve."""
    k = F.col("p_partkey")
    dag = t.part.select(k.alias("child"), (k + 1 + F.col("p_size") % 3).alias("parent")).unionByName(t.part.select(k.alias("child"), (k + 2).alias("parent")))
    dag = dag.filter(F.floor(F.col("child") / 12) == F.floor(F.col("parent") / 12)).distinct()
    pairs = dag.filter("child % 4 = 0").select(F.col("child").alias("start"), (F.col("child") + 5).alias("target")).distinct()
    return graph.shortest_paths(dag, pairs).withColumn("path", F.array_join(F.col("path").cast("array<string>"), ">"))


@query("""WITH RECURSIVE v AS (SELECT 'v' || p_size AS version, CASE WHEN p_size > 1 THEN 'v' || (p_size // 2) END AS extends
  FROM (SELECT DISTINCT p_size FROM part) UNION ALL SELECT 'x', 'y' UNION ALL SELECT 'y', 'x' UNION ALL SELECT 'm', 'v1' UNION ALL SELECT 'm', 'v2'),
c AS (SELECT version AS node, version AS ancestor FROM v UNION SELECT node, extends FROM c JOIN v ON version = ancestor WHERE extends IS NOT NULL)
SELECT node AS version, ancestor, CASE WHEN node IN ('x', 'y') THEN 'cycle' WHEN node = 'm' THEN 'several_parents' ELSE 'ok' END AS status FROM c""")
def version_lineage(t):
    sizes = t.part.select("p_size").distinct()
    v = sizes.select(tag("v", "p_size").alias("version"), F.when(F.col("p_size") > 1, F.concat(F.lit("v"), F.floor(F.col("p_size") / 2).cast("string"))).alias("extends"))
    odd = sizes.filter("p_size = 1").select(F.inline(F.array(*[F.struct(F.lit(a).alias("version"), F.lit(b).alias("extends")) for a, b in (("x", "y"), ("y", "x"), ("m", "v1"), ("m", "v2"))])))
    return graph.version_lineage(v.unionByName(odd))


TYPES = f"""{CLOSURE}, slots AS (SELECT DISTINCT o_orderpriority || (o_custkey % 20) AS role,
  CASE WHEN o_orderkey % 3 = 0 THEN 'n' || (o_custkey % 25) WHEN o_orderkey % 3 = 1 THEN 'r' || (o_custkey % 5) ELSE 'c' || o_custkey END AS type
  FROM orders),
cons AS (SELECT DISTINCT o_orderpriority || (o_custkey % 20) AS role,
  CASE WHEN o_custkey % 2 = 0 THEN 'n' || (o_custkey % 25) ELSE 'r' || (o_custkey % 5) END AS required_type FROM orders WHERE o_custkey % 20 < 12)"""


@query(f"""{TYPES}, p AS (SELECT s.role, s.type, c.required_type, s.type = c.required_type OR (s.type, c.required_type) IN (SELECT (node, ancestor)
  FROM closure) AS below, s.type = c.required_type OR (c.required_type, s.type) IN (SELECT (node, ancestor) FROM closure) AS above FROM slots s LEFT
  JOIN cons c USING (role))
SELECT role, type, CASE WHEN count(required_type) = 0 THEN 'no_direct_constraint' WHEN count(required_type) = 1 AND max(required_type) = type THEN 'direct_match' WHEN bool_and(below) THEN 'compatible_donor_subtype' WHEN bool_and(above) THEN 'incompatible_donor_supertype' ELSE 'incomparable_types' END AS relation_status
  FROM p GROUP BY role, type""")
def type_relation(t):
    c, k = F.col("o_custkey"), F.col("o_orderkey")
    role = F.concat("o_orderpriority", (c % 20).cast("string")).alias("role")
    name = lambda x, n: F.concat(F.lit(x), (c % n if n else c).cast("string"))
    slots = t.orders.select(role, F.when(k % 3 == 0, name("n", 25)).when(k % 3 == 1, name("r", 5)).otherwise(name("c", 0)).alias("type"))
    cons = t.orders.filter("o_custkey % 20 < 12").select(role, F.when(c % 2 == 0, name("n", 25)).otherwise(name("r", 5)).alias("required_type"))
    return graph.type_relation(slots, cons, graph.ancestor_closure(edges(t)))


@query(f"WITH {EDGES} SELECT DISTINCT child, parent FROM edges WHERE child IN (SELECT 'c' || c_custkey FROM customer WHERE c_acctbal > 0) AND parent IN (SELECT 'n' || n_nationkey FROM nation WHERE n_regionkey < 3)")
def induced_edges(t):
    nodes = t.customer.filter("c_acctbal > 0").select(tag("c", "c_custkey").alias("id")).unionByName(t.nation.filter("n_regionkey < 3").select(tag("n", "n_nationkey").alias("id")))
    return match.induced_edges(edges(t), nodes)


@query(f"""WITH {EDGES}, ax AS (SELECT child, parent, CASE WHEN child < 'c5' THEN 'main' ELSE 'other' END AS module FROM edges
  UNION ALL SELECT child, parent, 'main' FROM edges WHERE child LIKE 'n1%'),
st AS (SELECT c_custkey AS path_id, 0 AS step, 'c' || c_custkey AS child, 'n' || c_nationkey AS parent FROM customer
  UNION ALL SELECT c_custkey, 1, 'n' || c_nationkey, 'r' || n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT path_id, step, child, parent, (SELECT count(*) = 1 AND count_if(module = 'main') = 1 FROM ax WHERE ax.child = st.child AND ax.parent = st.parent) AS ok FROM st""")
def verified_path_edges(t):
    ax = edges(t).withColumn("module", F.when(F.col("child") < "c5", "main").otherwise("other"))
    ax = ax.unionByName(edges(t).filter("child like 'n1%'").withColumn("module", F.lit("main")))
    paths = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("path_id"), F.array(tag("c", "c_custkey"), tag("n", "c_nationkey"), tag("r", "n_regionkey")).alias("path"))
    return graph.verified_path_edges(paths, ax, "main")


@query("""WITH RECURSIVE a AS (SELECT o_orderkey AS id, o_orderpriority AS s FROM orders), b AS (SELECT o_orderkey AS id, o_orderkey // 2 AS f
  FROM orders WHERE o_orderkey % 3 <> 0 AND o_orderkey > 1),
c AS (SELECT id AS node, id AS cur FROM a UNION SELECT node, f FROM c JOIN b ON b.id = cur) SELECT DISTINCT node AS assertion_id, s AS schema_id FROM c JOIN a ON a.id = cur""")
def composition_reach(t):
    k = F.col("o_orderkey")
    b = t.orders.filter("o_orderkey % 3 <> 0 and o_orderkey > 1").select(k.alias("assertion_id"), F.lit("assertion").alias("filler_kind"), F.floor(k / 2).alias("filler_id"))
    return graph.composition_reach(t.orders.select(k.alias("assertion_id"), F.col("o_orderpriority").alias("schema_id")), b)


def _catalog(t):
    p = t.part.select(F.concat("p_brand", F.lit(" "), "p_type").alias("name"), F.col("p_name").alias("description"), F.lit("donor").alias("source"), F.col("p_partkey").alias("ord"))
    line = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    s = line.select(F.concat("p_brand", F.lit(" "), "p_type").alias("name"), F.when(F.col("l_linenumber") == 7, " ").otherwise(F.concat(F.lit("Role"), "l_linenumber")).alias("label"), F.when(F.col("l_suppkey") % 4 != 0, tag("n", "l_suppkey")).alias("type"), (F.col("l_quantity") > 45).cast("int").alias("required"), F.col("l_orderkey").alias("ord"))
    return catalog.compile_catalog(p, s, edges(t))


CATALOG = """p AS (SELECT p_brand || ' ' || p_type AS name, p_name AS d, p_partkey AS ord
  FROM part), s AS (SELECT 'lc:' || lower(p_brand || ' ' || p_type) AS predicate_id,
  CASE WHEN l_linenumber = 7 THEN ' ' ELSE 'Role' || l_linenumber END AS label,
 CASE WHEN l_suppkey % 4 <> 0 THEN 'n' || l_suppkey END AS type, l_quantity > 45 AS required FROM lineitem JOIN part ON l_partkey = p_partkey)"""


@query(f"WITH {CATALOG} SELECT 'lc:' || lower(trim(name)) AS predicate_id, min(name) AS preferred_label, arg_min(d, ord) AS description FROM p GROUP BY 1")
def catalog_predicates(t):
    return _catalog(t)["predicate_types"]


@query(f"WITH {CATALOG} SELECT predicate_id, 'lc.role.' || lower(trim(label)) AS role_id, bool_or(required) AS required, CASE WHEN bool_or(required) THEN 1 ELSE 0 END AS min_count, 1 AS max_count FROM s WHERE trim(label) <> '' GROUP BY 1, 2")
def catalog_role_edges(t):
    return _catalog(t)["predicate_role_edges"]


@query(f"WITH {CATALOG} SELECT DISTINCT predicate_id, 'lc.role.' || lower(trim(label)) AS role_id, 'lc:sumo_type.' || type AS expected_type FROM s WHERE trim(label) <> '' AND type IS NOT NULL")
def catalog_constraints(t):
    return _catalog(t)["constraints"]


@query(f"WITH {CATALOG}, k AS (SELECT DISTINCT type AS id FROM s WHERE trim(label) <> '' AND type IS NOT NULL), n AS (SELECT id FROM k UNION SELECT 'r' || n_regionkey FROM nation WHERE 'n' || n_nationkey IN (SELECT id FROM k)) SELECT DISTINCT 'n' || n_nationkey AS child, 'r' || n_regionkey AS parent FROM nation WHERE 'n' || n_nationkey IN (SELECT id FROM n)")
def catalog_hierarchy(t):
    return _catalog(t)["hierarchy_edges"]


@query(f"WITH {CATALOG} SELECT 'predicate_role_edges' AS asset, 'DANGLING_ROLE_ID' AS code, 'lc.role.role3' AS detail UNION ALL SELECT 'predicate_types', 'DUPLICATE_KEY', d FROM (SELECT arg_min(d, ord) AS d FROM p GROUP BY lower(name)) GROUP BY d HAVING count(*) > 1")
def validate_catalog(t):
    tables = dict(_catalog(t))
    tables["role_types"] = tables["role_types"].filter("role_id <> 'lc.role.role3'")
    return checks.catalog_violations(tables, {"predicate_types": ["description"], "role_types": ["role_id"]}, [("predicate_role_edges", "role_id", "role_types", "role_id"), ("constraints", "predicate_id", "predicate_types", "predicate_id")])


def _pack(t):
    """The catalog as a pack with its provenance, in which something of each kind is wrong."""
    made = _catalog(t)
    made = {n: written(made[n], n) for n in ("predicate_types", "predicate_role_edges", "entity_types", "constraints", "hierarchy_edges")}  # each is read many times
    predicates, roles, types, limits = (made[n] for n in ("predicate_types", "predicate_role_edges", "entity_types", "constraints"))
    hierarchy = made["hierarchy_edges"].select(*[F.concat(F.lit("lc:sumo_type."), c).alias(f"{c}_id") for c in ("child", "parent")])
    row = lambda df, kind, key, id_, relation: df.select(id_.alias("canonical_id"), F.lit(kind).alias("canonical_kind"), F.lit(key).alias("source_key"), id_.alias("source_id"), F.lit(relation).alias("relation"))
    slot, edge = F.concat_ws(":", "predicate_id", "role_id"), F.col("canonical_id")
    kept = F.col("predicate_id"), F.when(F.col("expected_type") == "lc:sumo_type.n5", "lc:sumo_type.zz").otherwise(F.col("expected_type"))
    senses = row(predicates, "predicate_type", "propbank", F.col("predicate_id"), "derived_from")
    mappings = [
        row(predicates.filter(F.length("predicate_id") % 5 > 0), "predicate_type", "donor", kept[0], "derived_from"),
        row(roles, "role_slot", "donor", slot, "positional_role"),
        row(roles.filter("role_id = 'lc.role.role2'"), "role_slot", "donor", slot, "positional_role"),
        row(limits.select("predicate_id", "expected_type").distinct(), "entity_type", "sumo_types", kept[1], "typed_by"),
        row(catalog.hierarchy_provenance(hierarchy).filter("canonical_id not like '%.r1'"), "hierarchy_edge", "sumo_types", edge, "subtype_of"),
        row(predicates.limit(1), "predicate_type", "wordnet", kept[0], "derived_from"),
        senses,
    ]
    system = senses.withColumnsRenamed({"source_key": "source_system", "relation": "mapping_type"})
    return {"predicate_types": predicates, "predicate_role_edges": roles, "entity_types": types, "constraints": limits, "hierarchy_edges": hierarchy, "source_mappings": system.filter(F.length("canonical_id") % 3 > 0), "semantic_mappings": reduce(lambda a, b: a.unionByName(b), mappings)}


PACK = f"""{CATALOG}, pr AS (SELECT DISTINCT 'lc:' || lower(trim(name)) AS id FROM p), ed AS (SELECT DISTINCT predicate_id, label FROM s
  WHERE trim(label) <> ''), ty AS (SELECT DISTINCT type FROM s WHERE trim(label) <> '' AND type IS NOT NULL),
hi AS (SELECT DISTINCT n_nationkey, n_regionkey FROM nation WHERE 'n' || n_nationkey IN (SELECT type FROM ty))"""


@query(f"""WITH {PACK}, v AS (SELECT 'semantic_mappings' AS asset, 'PREDICATE_NOT_COVERED' AS code, count(*) AS n FROM pr WHERE length(id) % 5 = 0
  UNION ALL SELECT 'semantic_mappings', 'ROLE_BAG', count(*) FROM ed WHERE label = 'Role2'
UNION ALL SELECT 'semantic_mappings', 'TYPE_BAG', 2 * count(*) FROM ty WHERE type = 'n5'
  UNION ALL SELECT 'semantic_mappings', 'DANGLING_ENTITY_TYPE', count(*) FROM ty WHERE type = 'n5'
  UNION ALL SELECT 'semantic_mappings', 'HIERARCHY_NOT_COVERED', count(*) FROM hi WHERE n_regionkey = 1
UNION ALL SELECT 'semantic_mappings', 'SENSE_BAG', count(*) FROM pr WHERE length(id) % 3 = 0
  UNION ALL SELECT 'semantic_mappings', 'UNDECLARED_SOURCE', 1 UNION ALL SELECT 'semantic_mappings', 'COUNT', 1
  UNION ALL SELECT 'entity_types', 'ROWS', 1 UNION ALL SELECT 'entity_types', 'DIGEST', 1 UNION ALL SELECT 'constraints', 'DIGEST', 1
  UNION ALL SELECT 'extra', 'UNEXPECTED', 1) SELECT * FROM v WHERE n > 0""")
def validate_pack(t):
    """A pack whose provenance has gaps, and of which rows were added and changed after it was published."""
    path = scratch(t.spark, "pack")
    remove_at_end(t.spark, path)
    data = f"{path}/{packs.publish(_pack(t), path)['data']}"
    tables = packs.read_set(t.spark, path)
    tables["entity_types"].limit(1).write.mode("append").parquet(f"{data}/entity_types")
    changed = tables["constraints"].withColumn("role_id", F.concat("role_id", F.lit("x")))
    changed.write.parquet(f"{path}/changed")
    t.spark.read.parquet(f"{path}/changed").write.mode("overwrite").parquet(f"{data}/constraints")
    t.nation.write.parquet(f"{data}/extra")
    found = packs.set_violations(t.spark, path).unionByName(checks.pack_violations(packs.read_set(t.spark, path), ["donor", "propbank", "sumo_types"], {"wordnet": 2}))
    return found.groupBy("asset", "code").agg(F.count("*").alias("n"))


@query(f"WITH {PACK}, n AS (SELECT 'predicate_types' AS asset, (SELECT count(*) FROM pr) AS rows UNION ALL SELECT 'predicate_role_edges', (SELECT count(*) FROM ed) UNION ALL SELECT 'entity_types', (SELECT count(*) FROM ty) UNION ALL SELECT 'hierarchy_edges', (SELECT count(*) FROM hi)) SELECT * FROM n")
def pack_counts(t):
    """Rows of the tables of a published pack, from its manifest."""
    path, tables = scratch(t.spark, "pack"), _pack(t)
    remove_at_end(t.spark, path)
    packs.publish({n: tables[n] for n in ("predicate_types", "predicate_role_edges", "entity_types", "hierarchy_edges")}, path)
    return packs.set_counts(t.spark, path)


@query("""WITH r AS (SELECT p_partkey, 'rel' || p_partkey || CASE WHEN p_partkey % 10 = 0 THEN 'Fn' ELSE '' END AS relation, p_size % 5 AS arity, p_brand AS module
  FROM part), m AS (SELECT DISTINCT p_brand AS module, CASE WHEN p_brand < 'Brand#3' THEN 'approved' WHEN p_brand < 'Brand#5' THEN 'rejected' END AS d
  FROM part),
n AS (SELECT 'lc:' || lower(relation) AS predicate_id, arity FROM r JOIN m USING (module)
  WHERE d = 'approved' AND relation NOT LIKE '%Fn' AND p_partkey % 6 <> 0) SELECT predicate_id, 'lc.role.relation_arg' || i AS role_id
  FROM (SELECT predicate_id, unnest(range(1, arity + 1)) AS i FROM n)""")
def additive_slice_edges(t):
    return _slice(t)["predicate_role_edges"]


@query("""WITH r AS (SELECT 'rel' || p_partkey || CASE WHEN p_partkey % 10 = 0 THEN 'Fn' ELSE '' END AS relation, p_brand AS module FROM part)
SELECT CASE WHEN relation LIKE '%Fn' THEN 'function' WHEN module < 'Brand#3' THEN 'approved' WHEN module < 'Brand#5' THEN 'reviewed_exclusion' ELSE 'unknown_module' END AS disposition, count(*) AS "count"
  FROM r GROUP BY 1""")
def filter_disposition(t):
    return _slice(t)["counts"]


def _typed_slice(t):
    """Relations of parts that require customers as types, below nations and regions; an ancestor owns the nations of even keys and what is above them."""
    k, n = F.col("p_partkey"), F.col("n_nationkey")
    rel, mods, owned = _slice_inputs(t)
    cons = t.part.join(rel, F.concat(F.lit("rel"), k.cast("string")) == F.regexp_replace("relation", "Fn$", "")).select("relation", F.lit(1).alias("position"), F.concat(F.lit("sumo:c"), (k % 1000).cast("string")).alias("required_type"), "module")
    hierarchy = edges(t).select(*[F.concat(F.lit("sumo:"), c).alias(c) for c in ("child", "parent")])
    nations = t.nation.filter(n % 2 == 0)
    types = nations.select(F.concat(F.lit("lc:sumo_type.n"), n.cast("string")).alias("type_id")).unionByName(t.nation.select(F.concat(F.lit("lc:sumo_type.r"), F.col("n_regionkey").cast("string")).alias("type_id")).distinct())
    owned = owned | {"types": types, "edges": nations.select(F.concat(F.lit("lc:sumo_type.n"), n.cast("string")).alias("child_id"), F.concat(F.lit("lc:sumo_type.r"), F.col("n_regionkey").cast("string")).alias("parent_id"))}
    return catalog.compile_additive_slice(rel, cons, mods, owned, hierarchy)


TYPED = """need AS (SELECT DISTINCT p_partkey % 1000 AS c FROM part
  WHERE p_brand < 'Brand#3' AND p_partkey % 10 <> 0 AND p_partkey % 6 <> 0 AND p_size % 5 >= 1), cu AS (SELECT c_custkey, c_nationkey FROM customer
  WHERE c_custkey IN (SELECT c FROM need)), na AS (SELECT * FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM cu))"""


@query(f"""WITH {TYPED} SELECT 'subtype_of' AS edge_type, 'lc:sumo_type.c' || c_custkey AS child_id, 'lc:sumo_type.n' || c_nationkey AS parent_id FROM cu
UNION SELECT 'subtype_of', 'lc:sumo_type.n' || n_nationkey, 'lc:sumo_type.r' || n_regionkey FROM na WHERE n_nationkey % 2 <> 0""")
def additive_slice_hierarchy(t):
    return _typed_slice(t)["hierarchy_edges"]


@query(f"""WITH {TYPED} SELECT 'lc:sumo_type.c' || c AS type_id, 'c' || c AS preferred_label FROM need
  UNION SELECT 'lc:sumo_type.n' || n_nationkey, 'n' || n_nationkey FROM na WHERE n_nationkey % 2 <> 0""")
def additive_slice_types(t):
    return _typed_slice(t)["entity_types"]


def _slice_inputs(t):
    k = F.col("p_partkey")
    rel = t.part.select(F.concat(F.lit("rel"), k.cast("string"), F.when(k % 10 == 0, "Fn").otherwise("")).alias("relation"), (F.col("p_size") % 5).alias("arity"), F.col("p_brand").alias("module"))
    mods = t.part.select(F.col("p_brand").alias("module"), F.when(F.col("p_brand") < "Brand#3", "approved").otherwise("rejected").alias("disposition")).distinct().filter("module < 'Brand#5'")
    owned = t.part.filter("p_partkey % 6 = 0").select(F.concat(F.lit("lc:rel"), k.cast("string")).alias("predicate_id"))
    none = owned.filter("false")
    return rel, mods, {"predicates": owned, "roles": none.select(F.col("predicate_id").alias("role_id")), "types": none.select(F.col("predicate_id").alias("type_id"))}


def _slice(t):
    rel, mods, owned = _slice_inputs(t)
    cons = rel.select("relation", F.lit(1).alias("position"), F.lit("sumo:Entity").alias("required_type"), "module")
    return catalog.compile_additive_slice(rel, cons, mods, owned)


PROVENANCE = """p AS (SELECT c_name AS n, 'lc:' || c_name AS id, CASE WHEN c_custkey % 2 = 0 THEN 's.' || c_custkey END AS sense,
  CASE WHEN c_custkey % 5 = 0 THEN CAST(c_custkey AS VARCHAR) END AS fr, CASE WHEN c_custkey % 10 = 0 THEN 'm' END AS m,
  CASE WHEN c_custkey % 15 = 0 THEN 0.5 END AS q, c_custkey FROM customer),
s AS (SELECT DISTINCT n, id, sense, 'L' || (o_orderkey % 3) AS label, 'ARG' || (o_orderkey % 3) AS arg, 'made by ' || o_orderstatus AS origin,
  CASE WHEN o_orderkey % 7 > 0 THEN o_orderpriority END AS type FROM orders JOIN p ON o_custkey = c_custkey)"""


@query(f"""WITH {PROVENANCE}, r AS (SELECT DISTINCT n, id, sense, origin, id || ':lc.role.' || lower(label) AS role, arg, 'role_slots[name=' || n || ',arg=' || arg || ']' AS ev
  FROM s)
SELECT id AS canonical_id, 'predicate_type' AS canonical_kind, 'donor' AS source_key, n AS source_id, 'derived_from' AS relation, 'direct_identifier' AS derivation_method, '{catalog.BASES["predicate"]}' AS confidence_basis, CAST(NULL AS VARCHAR) AS method_ref, CAST(NULL AS VARCHAR) AS method_scope, CAST(NULL AS DOUBLE) AS confidence, 'predicates[name=' || n || '].name' AS evidence_ref
  FROM p
UNION ALL SELECT id, 'predicate_type', 'propbank', sense, 'derived_from', 'direct_identifier', '{catalog.BASES["sense"]}', NULL, NULL, NULL, 'predicates[name=' || n || '].sense_id'
  FROM p WHERE sense IS NOT NULL
UNION ALL SELECT id, 'predicate_type', 'framenet_candidate', fr, 'candidate_alignment', 'donor_asserted', '{catalog.BASES["frame"]}', m,
  CASE WHEN m IS NOT NULL THEN 'unknown' END, q, 'predicates[name=' || n || ']{{frame_id,mapping_confidence,mapping_source}}' FROM p
  WHERE fr IS NOT NULL
UNION ALL SELECT DISTINCT role, 'role_slot', 'donor', n || ':' || arg, 'positional_role', 'direct_identifier', '{catalog.BASES["slot"]}', NULL, NULL, NULL, ev
  FROM r UNION ALL SELECT role, 'role_slot', 'propbank', sense || ':' || arg, 'positional_role', 'donor_asserted', replace('{catalog.BASES["sense_slot"]}', '{{}}', origin), NULL, NULL, NULL, ev
  FROM r WHERE sense IS NOT NULL
UNION ALL SELECT 'lc:sumo_type.' || lower(type), 'entity_type', 'sumo_types', type, 'typed_by', 'donor_asserted', '{catalog.BASES["type"]}', NULL, NULL, NULL, 'role_slots[name=' || n || ',arg=' || min(arg) || '].type_constraint'
  FROM s WHERE type IS NOT NULL GROUP BY n, type""")
def emit_provenance(t):
    k, o = F.col("c_custkey"), F.col("o_orderkey")
    p = t.customer.select(
        F.col("c_name").alias("name"),
        F.when(k % 2 == 0, F.concat(F.lit("s."), k.cast("string"))).alias("sense_id"),
        F.when(k % 5 == 0, k.cast("string")).alias("frame_id"),
        F.when(k % 10 == 0, "m").alias("mapping_source"),
        F.when(k % 15 == 0, 0.5).alias("mapping_confidence"),
    )
    m = (o % 3).cast("string")
    joined = t.orders.join(t.customer, F.col("o_custkey") == k)
    s = joined.select(F.col("c_name").alias("name"), F.concat(F.lit("L"), m).alias("label"), F.concat(F.lit("ARG"), m).alias("arg"), F.concat(F.lit("made by "), "o_orderstatus").alias("source"), F.when(o % 7 > 0, F.col("o_orderpriority")).alias("type"))
    return catalog.emit_provenance(p, s)
