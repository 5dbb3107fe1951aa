"""Hierarchies: closure, shortest paths, lineages, type relations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crosslink.scratch import remove_at_end, scratch, written


def _pairs(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("child").alias("node"), F.col("parent").alias("ancestor")).filter("node is not null and ancestor is not null").distinct()


def _found(every: DataFrame, new: DataFrame, stored: bool = False) -> tuple[DataFrame, DataFrame]:
    """(all pairs, those of them that weren't in ``every`` or are in ``new``): each round joins just what the last one found with all pairs.

    If both begin with the edges, all pairs after a round are those up to twice as far apart as before, and the new ones have every
    pair that is just as far apart as the last round reached. A longer way begins with one of these, so new pairs are only
    joined upwards. ``stored`` pairs that were there before may stand before new ones, so these are joined downwards too.
    """
    added = new
    while not new.isEmpty():
        more = new.alias("a").join(every.alias("b"), F.col("a.ancestor") == F.col("b.node")).select("a.node", "b.ancestor")
        if stored:
            more = more.unionByName(every.alias("a").join(new.alias("b"), F.col("a.ancestor") == F.col("b.node")).select("a.node", "b.ancestor"))
        new = written(more.distinct().join(every, ["node", "ancestor"], "left_anti"), "round")
        every, added = every.unionByName(new), added.unionByName(new)
    return every, added


def ancestor_closure(edges: DataFrame, reflexive: bool = True) -> DataFrame:
    """node, ancestor over edges (child, parent), safe with cycles.

    Each round joins just the pairs that the last one found with all pairs found so far, so paths double and about log(depth) rounds
    do, and no pair is derived from the same two again. New pairs are a table of their own each round; nothing is rewritten.
    """
    edges = _pairs(edges)
    first = written(edges, "round")
    every, _ = _found(first, first)
    nodes = edges.select("node").unionByName(edges.select(F.col("ancestor").alias("node"))).distinct()
    return every.unionByName(nodes.select("node", F.col("node").alias("ancestor"))).distinct() if reflexive else every


def closure_delta(closure: DataFrame, edges: DataFrame, reflexive: bool = True) -> DataFrame:
    """node, ancestor: the pairs that new edges (child, parent) add to a stored closure (node, ancestor); with it they are the closure of all edges.

    A round joins new pairs with all pairs; stored pairs never meet each other, so the work follows what is added. ``closure`` may
    hold the pairs of nodes with themselves; with ``reflexive`` nodes that it hasn't get theirs. It is read once a round, so it
    should be a written table.
    """
    edges, stored = _pairs(edges), closure.select("node", "ancestor")
    first = written(edges.join(stored, ["node", "ancestor"], "left_anti"), "round")
    _, added = _found(stored.unionByName(first), first, stored=True)
    if not reflexive:
        return added
    nodes = edges.select("node").unionByName(edges.select(F.col("ancestor").alias("node"))).distinct()
    own = nodes.select("node", F.col("node").alias("ancestor")).join(stored, ["node", "ancestor"], "left_anti")
    return added.unionByName(own).distinct()


def shortest_paths(edges: DataFrame, pairs: DataFrame) -> DataFrame:
    """start, target, length, n_paths, path: the shortest simple paths upwards, of any length; path only if it is the only one.

    Breadth first for all pairs (start, target) at once, until no front is left; a pair leaves once its target is reached. Counts are
    kept for each node reached and not for each path, so the work is bounded by pairs x nodes.
    """
    edges = edges.select("child", "parent").distinct()
    front = pairs.select("start", "target").distinct().withColumns({"at": F.col("start"), "n_paths": F.lit(1).cast("long"), "path": F.array("start")})
    front, path, done, depth = written(front, "front"), scratch(edges.sparkSession, "seen"), None, 0
    remove_at_end(edges.sparkSession, path)
    while not front.isEmpty():
        hit = front.filter("at = target").select("start", "target", F.lit(depth).alias("length"), "n_paths", F.when(F.col("n_paths") == 1, F.col("path")).alias("path"))
        done = hit if done is None else done.unionByName(hit)
        keys = front.select("start", "target", "at")
        keys.write.mode("append").parquet(path)  # what was seen grows; nothing is rewritten
        seen = edges.sparkSession.read.schema(keys.schema).parquet(path)
        open_ = front.join(hit.select("start", "target"), ["start", "target"], "left_anti")
        step = open_.join(edges, open_["at"] == edges.child).groupBy("start", "target", F.col("parent").alias("at")).agg(F.sum("n_paths").alias("n_paths"), F.first(F.concat("path", F.array("parent"))).alias("path"))
        front, depth = written(step.join(seen, ["start", "target", "at"], "left_anti"), "front"), depth + 1
    return done if done is not None else front.select("start", "target", F.lit(0).alias("length"), "n_paths", "path")


def version_lineage(versions: DataFrame) -> DataFrame:
    """version, ancestor, status: the chain of each version, itself included; cycle and several_parents are marked. versions: version, extends (null at the root)."""
    edges = versions.filter("extends is not null").select(F.col("version").alias("child"), F.col("extends").alias("parent"))
    strict = ancestor_closure(edges, reflexive=False)
    cyclic = strict.filter("node = ancestor").select("node").distinct().withColumn("__cycle", F.lit(True))
    many = edges.distinct().groupBy(F.col("child").alias("node")).count().filter("count > 1").select("node", F.lit(True).alias("__many"))
    every = versions.select(F.col("version").alias("node"), F.col("version").alias("ancestor")).unionByName(strict).distinct()
    bad = every.join(cyclic.select(F.col("node").alias("ancestor"), "__cycle"), "ancestor", "left").join(many.select(F.col("node").alias("ancestor"), "__many"), "ancestor", "left")
    states = bad.groupBy("node").agg(F.bool_or(F.coalesce("__cycle", F.lit(False))).alias("c"), F.bool_or(F.coalesce("__many", F.lit(False))).alias("m"))
    status = F.when(F.col("c"), "cycle").when(F.col("m"), "several_parents").otherwise("ok")
    return every.join(states.select("node", status.alias("status")), "node").select(F.col("node").alias("version"), "ancestor", "status")


def union_lineage(assets: DataFrame, lineage: DataFrame, version: str) -> DataFrame:
    """Rows of ``assets`` (with version) that a version inherits or has."""
    return assets.join(lineage.filter(F.col("version") == version).select(F.col("ancestor").alias("version")), "version", "left_semi")


def reaches_root(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """id, reached: whether a seed reaches a node without parents."""
    closure = ancestor_closure(edges)
    roots = closure.select(F.col("ancestor").alias("id")).distinct().join(edges.select(F.col("child").alias("id")).distinct(), "id", "left_anti")
    ok = closure.join(roots, closure.ancestor == roots.id, "left_semi").select(F.col("node").alias("id")).distinct().withColumn("__ok", F.lit(True))
    known = edges.select(F.col("child").alias("id")).unionByName(edges.select(F.col("parent").alias("id"))).distinct().withColumn("__known", F.lit(True))
    out = seeds.select("id").distinct().join(ok, "id", "left").join(known, "id", "left")
    return out.select("id", F.coalesce("__ok", F.col("__known").isNull()).alias("reached"))


def type_relation(slots: DataFrame, constraints: DataFrame, closure: DataFrame) -> DataFrame:
    """role, type, relation_status of each distinct slot against all required types of its role; closure: node, ancestor, reflexive."""
    s, c = slots.select("role", "type").distinct(), constraints.select("role", "required_type").distinct()
    pairs = s.join(c, "role", "left")
    up = closure.select(F.col("node").alias("type"), F.col("ancestor").alias("required_type"), F.lit(True).alias("__below")).distinct()
    down = closure.select(F.col("ancestor").alias("type"), F.col("node").alias("required_type"), F.lit(True).alias("__above")).distinct()
    pairs = pairs.join(up, ["type", "required_type"], "left").join(down, ["type", "required_type"], "left")
    below, above = F.bool_and(F.coalesce("__below", F.col("type") == F.col("required_type"))), F.bool_and(F.coalesce("__above", F.col("type") == F.col("required_type")))
    n, only = F.count("required_type"), F.max("required_type")
    status = F.when(n == 0, "no_direct_constraint").when((n == 1) & (only == F.col("type")), "direct_match").when(below, "compatible_donor_subtype").when(above, "incompatible_donor_supertype").otherwise("incomparable_types")
    return pairs.groupBy("role", "type").agg(status.alias("relation_status"))


def verified_path_edges(paths: DataFrame, axioms: DataFrame, module: str) -> DataFrame:
    """path_id, step, child, parent, ok: each step of a path must be exactly one axiom (child, parent, module) of one module."""
    steps = paths.select("path_id", F.posexplode(F.arrays_zip(F.col("path").alias("child"), F.slice("path", 2, F.greatest(F.size("path") - 1, F.lit(0))).alias("parent"))).alias("step", "e")).filter("e.parent is not null")
    n = axioms.groupBy("child", "parent").agg(F.count("*").alias("__n"), F.count_if(F.col("module") == module).alias("__own"))
    out = steps.select("path_id", "step", "e.child", "e.parent").join(n, ["child", "parent"], "left")
    return out.select("path_id", "step", "child", "parent", F.coalesce((F.col("__own") == 1) & (F.col("__n") == 1), F.lit(False)).alias("ok"))


def composition_reach(assertions: DataFrame, bindings: DataFrame) -> DataFrame:
    """assertion_id, schema_id: the schemas that an assertion reaches through fillers that are assertions, its own included."""
    edges = bindings.filter("filler_kind = 'assertion'").select(F.col("assertion_id").alias("child"), F.col("filler_id").alias("parent"))
    own = assertions.select(F.col("assertion_id").alias("node"), F.col("assertion_id").alias("ancestor"))
    every = ancestor_closure(edges, reflexive=False).unionByName(own)
    return every.join(assertions.select(F.col("assertion_id").alias("ancestor"), "schema_id"), "ancestor").select(F.col("node").alias("assertion_id"), "schema_id").distinct()
