"""Metrics with refusal, distributions, correlations, factors, calibration."""

from pyspark.sql import functions as F

from crosslink.functions import texts as X
from crosslink.functions import values as V
from crosslink.operators import metrics as M
from crosslink.operators import windows as Wn
from crosslink.plans.ruling import HEADS, NOTICE
from crosslink.plans.base import query, rounded

# events as windows: reference from the type, prediction by a band around a center
EVENTS = "ev AS (SELECT *, user_id % 5 AS grp, CASE WHEN event_type IN ('purchase', 'signup') THEN 'contact' ELSE 'no_contact' END AS ref FROM events WHERE value IS NOT NULL)"


def events(t):
    return t.events.filter("value is not null").withColumn("grp", F.col("user_id") % 5).withColumn("ref", F.when(F.col("event_type").isin("purchase", "signup"), "contact").otherwise("no_contact"))


def predicted(t, center=50.0, half=10.0):
    return events(t).withColumn("pred", V.band(F.col("value"), F.lit(center), F.lit(half)))


PRED = EVENTS + ", pr AS (SELECT *, CASE WHEN value >= 50.0 + 10.0 THEN 'contact' WHEN value <= 50.0 - 10.0 THEN 'no_contact' ELSE 'refused' END AS pred FROM ev)"
METRICS = """count(*) AS n, round(count_if(pred <> 'refused') / count(*), 6) AS coverage, round(count_if(ref = pred) / count(*), 6) AS accuracy,
 round(count_if(ref = pred AND pred <> 'refused') / nullif(count_if(pred <> 'refused'), 0), 6) AS covered_accuracy,
 round((count_if(ref = 'contact' AND ref = pred) / nullif(count_if(ref = 'contact'), 0) + count_if(ref = 'no_contact' AND ref = pred) / nullif(count_if(ref = 'no_contact'), 0)) / 2, 6) AS balanced_accuracy,
 CAST(count_if(ref = 'no_contact' AND pred = 'contact') AS BIGINT) AS false_positives, CAST(count_if(ref = 'contact' AND pred = 'no_contact') AS BIGINT) AS false_negatives, CAST(count_if(pred = 'refused') AS BIGINT) AS refusals"""
RATES = ("coverage", "accuracy", "covered_accuracy", "balanced_accuracy")


@query(f"WITH {PRED} SELECT ref AS reference, CAST(count_if(pred = 'contact') AS BIGINT) AS n_contact, CAST(count_if(pred = 'no_contact') AS BIGINT) AS n_no_contact, CAST(count_if(pred = 'refused') AS BIGINT) AS n_refused, count(*) AS n_total FROM pr GROUP BY ref")
def confusion(t):
    return M.confusion(predicted(t), "ref", "pred", ["contact", "no_contact", "refused"])


@query(f"WITH {PRED} SELECT grp, event_type, CASE WHEN grouping(grp) = 0 THEN 'group' ELSE 'all' END AS scope, {METRICS} FROM pr GROUP BY GROUPING SETS ((grp, event_type), ())")
def grouped_metrics(t):
    out = M.grouped_metrics(predicted(t), ["grp", "event_type"], M.refusal_metrics(F.col("ref"), F.col("pred"), "contact", "no_contact"))
    return rounded(out, *RATES)


GRID = [float(x) for x in range(20, 81, 5)]


def _grid(t):
    return M.grid_search(events(t), "value", "ref", GRID, 5.0, "contact", "no_contact")


GRID_SQL = f"{EVENTS}, g AS (SELECT unnest({GRID}) AS center), pr AS (SELECT *, CASE WHEN value >= center + 5.0 THEN 'contact' WHEN value <= center - 5.0 THEN 'no_contact' ELSE 'refused' END AS pred FROM ev, g), gr AS (SELECT CAST(center AS DOUBLE) AS center, {METRICS} FROM pr GROUP BY center)"


@query(f"WITH {GRID_SQL} SELECT * FROM gr")
def grid_search(t):
    return rounded(_grid(t), *RATES)


@query(f"WITH {GRID_SQL} SELECT * FROM gr ORDER BY balanced_accuracy DESC, coverage DESC, center LIMIT 1")
def argmax_tiebreak(t):
    return M.best_of_grid(rounded(_grid(t), *RATES))


@query(f"WITH {EVENTS} SELECT round(quantile_cont(CASE WHEN ref = 'contact' THEN value END, 0.1), 6) AS low, round(quantile_cont(CASE WHEN ref = 'no_contact' THEN value END, 0.9), 6) AS high FROM ev WHERE user_id % 3 <> 0")
def calibrate_quantiles(t):
    return rounded(M.calibrate(events(t).filter("user_id % 3 <> 0"), "ref", "value", {"low": ("contact", 0.1), "high": ("no_contact", 0.9)}), "low", "high")


@query("""SELECT user_id, event_type, count(value) AS n, round(avg(value), 6) AS mean, round(median(value), 6) AS median, round(stddev_pop(value), 6) AS std, round(sqrt(avg(value * value)), 6) AS rms
  FROM events GROUP BY ALL""")
def window_features(t):
    return rounded(M.window_features(t.events, ["user_id", "event_type"], "value"), "mean", "median", "std", "rms")


@query("""WITH q AS (SELECT user_id, quantile_cont(value, 0.05) AS a, quantile_cont(value, 0.95) AS b FROM events
  GROUP BY 1) SELECT event_id, round(CASE WHEN b > a THEN greatest(0, least(1, (value - a) / (b - a))) END, 6) AS normal FROM events
  JOIN q USING (user_id)""")
def percentile_normalize(t):
    return rounded(Wn.percentile_normalized(t.events, ["user_id"], "value").select("event_id", "normal"), "normal")


@query("""WITH r AS (SELECT p_brand, rank() OVER (PARTITION BY p_brand
  ORDER BY p_size) + (count(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2 AS x, rank() OVER (PARTITION BY p_brand
  ORDER BY p_retailprice) + (count(*) OVER (PARTITION BY p_brand, p_retailprice) - 1) / 2 AS y FROM part)
SELECT p_brand, count(*) AS n, round(CASE WHEN stddev_pop(x) > 0 AND stddev_pop(y) > 0 THEN corr(x, y) END, 6) AS rho FROM r GROUP BY p_brand""")
def spearman(t):
    return rounded(M.spearman(t.part, "p_size", "p_retailprice", ["p_brand"]), "rho")


BANDS = [("low", 0.0, 900.0), ("mid", 950.0, 1200.0), ("high", 1200.0, 5000.0)]


@query("""SELECT band, count(*) AS n, round(count_if(p_size > 25) / count(*), 6) AS bad_rate FROM (SELECT *,
  CASE WHEN p_retailprice BETWEEN 0 AND 900 THEN 'low' WHEN p_retailprice BETWEEN 950 AND 1200 THEN 'mid' WHEN p_retailprice BETWEEN 1200 AND 5000 THEN 'high' END AS band
  FROM part) WHERE band IS NOT NULL GROUP BY band""")
def band_histogram(t):
    return rounded(M.band_histogram(t.part.withColumn("bad", F.col("p_size") > 25), "p_retailprice", "bad", BANDS), "bad_rate")


@query("""WITH c AS (SELECT o_orderpriority AS relation, count(*) AS n, round(avg(o_totalprice), 4) AS mean_confidence, round(sum(o_totalprice), 2) AS cost
  FROM orders GROUP BY 1) SELECT relation, n, round(n / sum(n) OVER (), 6) AS share, mean_confidence, cost, CAST(row_number() OVER (ORDER BY n DESC, relation) AS INTEGER) AS place
  FROM c""")
def relation_distribution(t):
    out = M.relation_distribution(t.orders, "o_orderpriority", "o_totalprice", "o_totalprice")
    return out.withColumns({"share": F.round("share", 6), "mean_confidence": F.round("mean_confidence", 4), "cost": F.round("cost", 2)})


@query("""SELECT user_id, count(*) AS runs,
  CASE WHEN bool_and(value > 10) THEN 'always_right' WHEN bool_or(value > 10) THEN 'flaky' ELSE 'always_wrong' END AS stability FROM events
  WHERE event_type = 'purchase' GROUP BY 1""")
def run_stability(t):
    return M.run_stability(t.events.filter("event_type = 'purchase'").withColumn("right", F.col("value") > 10), "user_id", "right")


@query("""SELECT CAST(count_if(quality = 1) AS BIGINT) AS n_same, CAST(count_if(quality = 1 AND toxic = 0) AS BIGINT) AS under_collapsed, CAST(count_if(quality = 0) AS BIGINT) AS n_different, CAST(count_if(quality = 0 AND toxic = 1) AS BIGINT) AS over_collapsed
  FROM labels""")
def collapse_rates(t):
    df = t.labels.select(F.when(F.col("quality") == 1, "same").otherwise("different").alias("label"), (F.col("toxic") == 1).alias("c"))
    return M.collapse_rates(df, "label", "c", ["same"], ["different"])


@query("SELECT lang, source, count(*) AS n, CAST(grouping_id(lang, source) AS BIGINT) AS level FROM documents GROUP BY GROUPING SETS ((lang, source), (lang), (source), ())")
def segment_counts(t):
    return M.segment_counts(t.documents, "lang", "source")


@query("""SELECT user_id, event_type, round(avg(value), 6) AS mean, round(max(value) - min(value), 6) AS spread, max(value) - min(value) < 50 AS stable, arg_min(value, (ts, value)) AS first_value, arg_max(value, (ts, value)) AS last_value, (arg_min(value, (ts, value)) > 40) <> (arg_max(value, (ts, value)) > 40) AS changed, count(*) AS n, string_agg(CAST(event_id AS VARCHAR), ','
  ORDER BY event_id) AS evidence FROM events GROUP BY user_id, event_type""")
def channel_factors(t):
    out = M.channel_factors(t.events, "user_id", "event_type", "ts", "value", "event_id", 50.0, 40.0)
    return rounded(out.withColumn("evidence", F.array_join(F.col("evidence").cast("array<string>"), ",")), "mean", "spread")


@query("""WITH g AS (SELECT user_id, max(gap) AS max_gap FROM (SELECT user_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id
  ORDER BY ts) AS gap FROM (SELECT DISTINCT user_id, ts FROM events)) GROUP BY 1)
SELECT user_id, count(DISTINCT event_type) = 1 AS one_signature, count(DISTINCT props) AS n_instances, max_gap FROM events JOIN g USING (user_id) GROUP BY user_id, max_gap""")
def identity_factors(t):
    us = t.events.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    return M.identity_factors(us, "user_id", "us", "event_type", "props")


@query("""WITH s AS (SELECT l_orderkey AS k, CASE WHEN l_returnflag = 'N' THEN 'asserted' ELSE 'unknown' END AS s FROM lineitem), g AS (SELECT k,
  CASE WHEN bool_and(s = 'asserted') THEN 'asserted' WHEN bool_and(s = 'unknown') THEN 'unknown' ELSE 'mixed' END AS lineage, count_if(s = 'unknown') AS u
  FROM s GROUP BY k)
SELECT k, lineage, concat_ws(',', CASE WHEN u > 0 THEN 'unknown_source' END, CASE WHEN lineage = 'mixed' THEN 'mixed_lineage' END) AS warnings FROM g""")
def lineage_rollup(t):
    return M.lineage_rollup(t.lineitem.select(F.col("l_orderkey").alias("k"), F.when(F.col("l_returnflag") == "N", "asserted").otherwise("unknown").alias("s")), "k", "s")


@query("""WITH r AS (SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n, max(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS role, max(o_orderpriority) AS p
  FROM orders GROUP BY 1, 2)
SELECT o_custkey, string_agg(y || ':' || n, ','
  ORDER BY y) AS counts, CAST(count_if(role IS NOT NULL) AS BIGINT) AS runs_with_role, array_to_string(list_sort(list(DISTINCT p)), ',') AS predicates
  FROM r GROUP BY 1""")
def probe_summary(t):
    r = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"), F.max(F.when(F.col("o_orderstatus") == "F", 1)).alias("role"), F.max("o_orderpriority").alias("p"))
    return M.probe_summary(r, ["o_custkey"], "y", "n", "role", "p")


@query("SELECT CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS \"n_F\", CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS \"n_O\", CAST(count_if(o_orderstatus = 'X') AS BIGINT) AS \"n_X\", count(*) AS n_total, round(coalesce(sum(CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_totalprice END), 0), 2) AS cost FROM orders")
def outcome_summary(t):
    return rounded(M.outcome_summary(t.orders.withColumn("c", F.when(F.col("o_custkey") % 3 != 0, F.col("o_totalprice"))), "o_orderstatus", ["F", "O", "X"], ["c"]), "cost", digits=2)


@query("""WITH i AS (SELECT o_orderkey AS a, unnest(range(CAST(o_custkey % 4 AS BIGINT))) AS b FROM orders), n AS (SELECT a, b % 2 AS r, count(*) AS n FROM i GROUP BY 1, 2),
w AS (SELECT o_orderkey AS a, r, 1 AS lo, 1 AS hi FROM orders, (SELECT unnest([0, 1]) AS r))
SELECT CAST(w.a AS BIGINT) AS assertion_id, CAST(w.r AS BIGINT) AS role_id, coalesce(n, 0) AS n,
  CASE WHEN coalesce(n, 0) < lo THEN 'TOO_FEW' ELSE 'TOO_MANY' END AS code FROM w LEFT JOIN n ON n.a = w.a AND n.r = w.r
  WHERE coalesce(n, 0) < lo OR coalesce(n, 0) > hi""")
def cardinality_check(t):
    k = F.col("o_orderkey").alias("assertion_id")
    b = t.orders.filter("o_custkey % 4 > 0").select(k, F.explode(F.sequence(F.lit(0).cast("long"), F.col("o_custkey") % 4 - 1)).alias("i")).select("assertion_id", (F.col("i") % 2).alias("role_id"))
    roles = t.orders.select(k, F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("role_id"), F.lit(1).alias("min_count"), F.lit(1).alias("max_count"))
    return M.cardinality_violations(roles, b)


@query("""WITH w AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e
  FROM embeddings), m AS (SELECT vec_id, sqrt(e[1] * e[1] + e[2] * e[2] + e[3] * e[3]) AS f, e[1] AS x, e[2] AS y, e[3] AS z
  FROM w), p AS (SELECT x AS base, unnest([x, z, -y]) AS f FROM m)
SELECT count(*) AS n, round(avg(CAST((CASE WHEN base >= 0.05 THEN 1 WHEN base <= -0.05 THEN -1 ELSE 0 END) = (CASE WHEN f >= 0.05 THEN 1 WHEN f <= -0.05 THEN -1 ELSE 0 END) AS INTEGER)), 6) AS unchanged, round(max(abs(base - f)), 6) AS max_drift
  FROM p""")
def perturbation_stability(t):
    v = F.slice("embedding", 1, 3).cast("array<double>")
    out = M.perturbation_stability(t.embeddings, v[0], {"x90": V.rotated(v, "x90")[0], "y90": V.rotated(v, "y90")[0], "z90": V.rotated(v, "z90")[0]}, lambda f: V.band(f, F.lit(0.0), F.lit(0.05)))
    return rounded(out, "unchanged", "max_drift")


@query("""WITH d AS (SELECT event_id, value AS a, value * 2 AS b, value + event_id % 10 AS c FROM events) SELECT *
  FROM (SELECT event_id, 'a' AS dropped, round(b + c, 6) AS total FROM d UNION ALL SELECT event_id, 'b', round(a + c, 6) FROM d
  UNION ALL SELECT event_id, 'c', round(a + b, 6) FROM d)""")
def dropout_channels(t):
    v = F.col("value")
    return rounded(M.dropout(t.events.select("event_id", v.alias("a"), (v * 2).alias("b"), (v + F.col("event_id") % 10).alias("c")), ["a", "b", "c"], ["event_id"]), "total")


@query("""WITH d AS (SELECT event_type AS grp,
  CASE WHEN user_id % 2 = 0 THEN 'contact' ELSE 'no_contact' END AS ref, value AS a, value * 2 AS b, value + event_id % 10 AS c
  FROM events), t AS (SELECT grp, ref, 'a' AS dropped, b + c AS s FROM d UNION ALL SELECT grp, ref, 'b', a + c FROM d
  UNION ALL SELECT grp, ref, 'c', a + b FROM d),
p AS (SELECT *, CASE WHEN s >= 160 THEN 'contact' WHEN s <= 140 THEN 'no_contact' ELSE 'refused' END AS pred FROM t)
SELECT dropped, grp, CASE WHEN grouping(grp) = 0 THEN 'group' ELSE 'all' END AS scope, count(*) AS n, round(count_if(pred <> 'refused') / count(*), 6) AS coverage, round(count_if(pred = ref) / count(*), 6) AS accuracy, CAST(count_if(pred = 'refused') AS BIGINT) AS refusals
  FROM p GROUP BY GROUPING SETS ((dropped, grp), (dropped))""")
def dropout_metrics(t):
    v = F.col("value")
    rows = t.events.select(F.col("event_type").alias("grp"), F.when(F.col("user_id") % 2 == 0, "contact").otherwise("no_contact").alias("ref"), v.alias("a"), (v * 2).alias("b"), (v + F.col("event_id") % 10).alias("c"))
    out = M.dropout_metrics(rows, ["a", "b", "c"], ["grp"], "ref", lambda s: V.band(s, F.lit(150.0), F.lit(10.0)), "contact", "no_contact")
    return rounded(out.select("dropped", "grp", "scope", "n", "coverage", "accuracy", "refusals"), "coverage", "accuracy")


@query("SELECT 'customer' AS asset, count(*) AS rows FROM customer UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'documents', count(*) FROM documents")
def compile_stats(t):
    return M.inventory({"customer": t.customer, "orders": t.orders, "documents": t.documents})


@query("""WITH s AS (SELECT o_orderpriority AS asset, count_if(o_orderstatus = 'F') AS selected, count(*) AS available FROM orders
  GROUP BY 1), e AS (SELECT o_orderpriority AS asset, count_if(o_orderstatus = 'F') AS selected, count(*) + CASE WHEN o_orderpriority LIKE '2%' THEN 1 ELSE 0 END AS available
  FROM orders GROUP BY 1)
SELECT asset, CAST(s.selected AS BIGINT) AS selected, s.available, s.selected = e.selected AND s.available = e.available AS ok FROM s JOIN e USING (asset)""")
def inventory_counts(t):
    s = t.orders.groupBy(F.col("o_orderpriority").alias("asset")).agg(M.n_if(F.col("o_orderstatus") == "F").alias("selected"), F.count("*").alias("available"))
    return M.inventory_check(s, s.withColumn("available", F.col("available") + F.startswith("asset", F.lit("2")).cast("int")))


@query("""SELECT l_partkey AS term, arg_min(l_orderkey * 10 + l_linenumber, (CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END,
  CASE WHEN l_linestatus = 'O' THEN 0 ELSE 1 END, l_orderkey, l_linenumber * 1000 + l_suppkey)) AS ref FROM lineitem GROUP BY 1""")
def first_witness(t):
    refs = t.lineitem.select(F.col("l_partkey").alias("term"), (F.col("l_returnflag") == "N").alias("is_declaration"), F.col("l_linestatus").alias("module"), F.col("l_orderkey").alias("path"), (F.col("l_linenumber") * 1000 + F.col("l_suppkey")).alias("idx"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ref"))
    return M.first_witness(refs, "O")


@query("""WITH r AS (SELECT l_partkey AS term, l_orderkey AS path, CAST(l_linenumber AS BIGINT) AS idx FROM lineitem UNION SELECT p_partkey, p_size, p_partkey FROM part)
SELECT term, count(*) AS n_refs, string_agg(path || '#' || lpad(CAST(idx AS VARCHAR), 9, '0'), ','
  ORDER BY path || '#' || lpad(CAST(idx AS VARCHAR), 9, '0')) AS refs FROM r GROUP BY term""")
def term_inventory(t):
    a = t.lineitem.select("l_partkey", F.col("l_orderkey").alias("path"), F.col("l_linenumber").cast("long").alias("idx"))
    b = t.part.select("p_partkey", F.col("p_size").cast("long").alias("path"), F.col("p_partkey").alias("idx"))
    return M.term_inventory({"line": (a, ["l_partkey"]), "part": (b, ["p_partkey"])}).withColumn("refs", F.array_join("refs", ","))


@query("""WITH d AS (SELECT count(*) AS rows, count(*) || '-' || sum(CAST(CAST('0x' || substr(sha256('v' || o_orderkey || chr(31) || 'v' || o_custkey || chr(31) || 'v' || o_orderdate), 1, 14) AS BIGINT) AS HUGEINT)) AS digest
  FROM orders) SELECT unnest([1, 2]) AS copy, rows, digest FROM d""")
def content_digest(t):
    a, b = (M.content_digest(df.select("o_orderkey", "o_custkey", "o_orderdate"), ["o_orderkey", "o_custkey", "o_orderdate"]) for df in (t.orders, t.orders.orderBy(F.desc("o_totalprice"))))
    return a.withColumn("copy", F.lit(1)).unionByName(b.withColumn("copy", F.lit(2)))


@query("""SELECT doc_id, CAST((length(text) - length(replace(text, 'the ', ''))) // 4 AS BIGINT) AS n,
  CASE WHEN (length(text) - length(replace(text, 'licensed', ''))) // 8 = 1 THEN CAST(instr(text, 'licensed') - 1 AS INTEGER) END AS place
  FROM documents""")
def occurrence_count(t):
    return t.documents.select("doc_id", X.occurrences(F.col("text"), F.lit("the ")).alias("n"), X.only_place(F.col("text"), F.lit("licensed")).alias("place"))


@query(f"WITH {HEADS} SELECT doc_id, kind FROM hc")
def header_class(t):
    return t.documents.select("doc_id", X.header_class(F.col("text"), F.col("doc_id") % 2 == 0, NOTICE).alias("kind"))


@query("""SELECT doc_id, CASE WHEN len(string_split(text, chr(10))) >= 3 THEN array_to_string(list_transform(string_split(text, chr(10))[2:3], lambda x: rtrim(x)), chr(10)) END AS lines
  FROM documents""")
def line_range(t):
    return t.documents.select("doc_id", X.line_range(F.col("text"), 2, 3).alias("lines"))


@query("""SELECT doc_id, CASE WHEN doc_id % 5 > 0 AND length(text) - length(replace(text, 'icensed', '')) = 7 THEN replace(text, 'icensed', 'icenced') END AS repaired, left(replace(text, 'icense', '[redacted]'), 4000) AS redacted
  FROM documents""")
def text_repairs(t):
    """A repair of every fifth document is of another version of it, so it isn't applied."""
    sha = F.when(F.col("doc_id") % 5 > 0, F.sha2("text", 256)).otherwise(F.sha2(F.concat("text", F.lit(".")), 256))
    return t.documents.select("doc_id", X.repaired(F.col("text"), F.lit("icensed"), F.lit("icenced"), sha).alias("repaired"), X.redacted(F.col("text"), ["icense"]).alias("redacted"))


@query("""WITH q AS (SELECT doc_id, text,
  CASE WHEN doc_id % 4 = 0 THEN 'other' ELSE 'text' END AS field, coalesce(string_split(text, chr(10))[2], '') AS quote
  FROM documents), n AS (SELECT *, CASE WHEN length(quote) > 0 THEN (length(text) - length(replace(text, quote, ''))) // length(quote) ELSE 0 END AS n
  FROM q)
SELECT doc_id, CASE WHEN field = 'other' THEN 'missing_field' WHEN length(quote) = 0 THEN 'empty_quote' WHEN n = 0 THEN 'not_found' WHEN n > 1 THEN 'ambiguous' ELSE 'grounded' END AS status,
CASE WHEN field = 'text' AND n = 1 THEN CAST(instr(text, quote) - 1 AS INTEGER) END AS start,
  CASE WHEN field = 'text' AND n = 1 THEN CAST(instr(text, quote) - 1 + length(quote) AS INTEGER) END AS "end" FROM n""")
def ground_quotes(t):
    field = F.when(F.col("doc_id") % 4 == 0, "other").otherwise("text")
    g = X.grounded_quote(F.create_map(F.lit("text"), F.col("text")), field, F.coalesce(F.get(F.split("text", "\n"), F.lit(1)), F.lit("")))
    return t.documents.select("doc_id", g.alias("g")).select("doc_id", "g.status", "g.start", "g.end")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_scalar(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("""SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, regexp_matches(regexp_replace(url, '^https?://[^/]+/?', ''), '^[^/]+$') AND NOT contains(regexp_replace(url, '^https?://[^/]+/?', ''), chr(92)) AND regexp_replace(url, '^https?://[^/]+/?', '') NOT IN ('.', '..') AS basename
  FROM pages""")
def path_scalars(t):
    from crosslink.functions.ids import is_basename

    return t.pages.select("page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"), is_basename(F.regexp_replace("url", "^https?://[^/]+/?", "")).alias("basename"))
