"""Intervals, gaps, windows over samples, samples of rows."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from crosslink.operators import windows as Wn
from crosslink.plans.base import query, rounded

SAMPLES = "sm AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events)"


def samples(t):
    return t.events.withColumn("i", (F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id")) - 1).cast("long"))


INTERVALS = """iv AS (SELECT * FROM (SELECT user_id, epoch_us(ts) AS start, lead(epoch_us(ts)) OVER w AS "end", event_type AS first, lead(event_type) OVER w AS second
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE "end" IS NOT NULL)"""


def micros(t):
    return t.events.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))


def intervals_of(t):
    return Wn.intervals(micros(t), ["user_id"], "us", "event_type", ["event_id"])


@query(f"WITH {INTERVALS} SELECT * FROM iv")
def consecutive_intervals(t):
    return intervals_of(t)


@query("""WITH l AS (SELECT conv_id, turn, role, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations WHERE conv_id % 3 <> 0 OR turn <> 1)
SELECT conv_id, turn AS at, role AS label, 'REPEATED' AS code FROM l WHERE role = p UNION ALL SELECT conv_id, NULL, NULL, 'TOO_FEW' FROM l GROUP BY conv_id HAVING count(*) < 2""")
def alternation_check(t):
    return Wn.alternation_violations(t.conversations.filter("conv_id % 3 <> 0 or turn <> 1"), ["conv_id"], "turn", "role", [])


@query("SELECT user_id, max(gap) AS max_gap FROM (SELECT user_id, us - lag(us) OVER (PARTITION BY user_id ORDER BY us) AS gap FROM (SELECT DISTINCT user_id, epoch_us(ts) AS us FROM events)) GROUP BY 1")
def max_gap(t):
    return Wn.max_gap(micros(t), ["user_id"], "us")


@query(f'WITH {SAMPLES} SELECT user_id, CAST(i // 8 AS BIGINT) AS "window", count(*) AS n, round(median(value), 6) AS feature FROM sm GROUP BY 1, 2 HAVING count(*) = 8')
def tumbling_samples(t):
    return rounded(Wn.tumbling(samples(t), ["user_id"], "i", 8, [F.median("value").alias("feature")]), "feature")


@query(f"WITH {SAMPLES}, st AS (SELECT DISTINCT user_id, unnest(range(0, 200, 4)) AS start FROM sm) SELECT user_id, CAST(start AS BIGINT) AS start, count(*) AS n, round(avg(value), 6) AS feature FROM st JOIN sm USING (user_id) WHERE i >= start AND i < start + 12 GROUP BY 1, 2 HAVING count(*) = 12")
def sliding_samples(t):
    return rounded(Wn.sliding(samples(t), ["user_id"], "i", 12, 4, [F.avg("value").alias("feature")]), "feature")


SEGMENTS = """sg AS (SELECT user_id, CAST(min(i) AS BIGINT) AS start, CAST(max(i) AS BIGINT) AS "end", event_type AS activity FROM sm GROUP BY user_id, event_type),
cw AS (SELECT *, start + ("end" - start + 1 - least(16, "end" - start + 1)) // 2 AS ws, least(16, "end" - start + 1) AS n FROM sg WHERE "end" > start)"""


def segments(t):
    return samples(t).groupBy("user_id", F.col("event_type").alias("activity")).agg(F.min("i").alias("start"), F.max("i").alias("end"))


@query(f'WITH {SAMPLES}, {SEGMENTS} SELECT user_id, start, "end", activity, ws, ws + n AS we FROM cw')
def central_window(t):
    return Wn.central_window(segments(t), most=16)


@query(f"WITH {SAMPLES}, {SEGMENTS} SELECT user_id, activity, count(*) AS n, round(avg(value), 6) AS mean FROM cw JOIN sm USING (user_id) WHERE i >= ws AND i < ws + cw.n GROUP BY 1, 2")
def samples_in_segments(t):
    s = samples(t).select("user_id", "i", "value")
    out = Wn.samples_in_segments(s, Wn.central_window(segments(t), most=16), ["user_id"], "i", 32)
    return rounded(out.groupBy("user_id", "activity").agg(F.count("*").alias("n"), F.avg("value").alias("mean")), "mean")


@query(f"""WITH {INTERVALS}, w AS (SELECT user_id, h * 3600000000 AS start, h * 3600000000 + 1800000000 AS "end"
  FROM (SELECT DISTINCT user_id, epoch_us(ts) // 3600000000 + unnest([0, 1, 5]) AS h FROM events))
SELECT w.user_id, w.start, w."end", iv.first AS reference FROM w LEFT JOIN iv ON iv.user_id = w.user_id AND w.start >= iv.start + 60000000 AND w."end" <= iv."end" - 60000000""")
def window_in_intervals(t):
    hour = F.floor(F.col("us") / 3600000000)
    w = micros(t).select("user_id", F.explode(F.array(hour, hour + 1, hour + 5)).alias("h")).distinct().select("user_id", (F.col("h") * 3600000000).alias("start"), (F.col("h") * 3600000000 + 1800000000).alias("end"))
    parts = intervals_of(t).select("user_id", "start", "end", F.col("first").alias("label"))
    return Wn.windows_in_intervals(w, parts, ["user_id"], 60000000)


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority = '1-URGENT' DESC, o_totalprice DESC, o_orderkey LIMIT 25")
def priority_limit(t):
    return Wn.priority_limit(t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"), [F.desc(F.col("o_orderpriority") == "1-URGENT"), F.desc("o_totalprice"), "o_orderkey"], 25)


@query("SELECT event_id, user_id, value FROM events WHERE NOT (value > 20) ORDER BY user_id, event_id LIMIT 30")
def bounded_failures(t):
    df = t.events.withColumn("right", F.col("value") > 20)
    return Wn.bounded_failures(df, "right", ["user_id", "event_id"], 30).select("event_id", "user_id", "value")


@query("SELECT c_custkey FROM customer ORDER BY sha256('7:' || c_custkey), c_custkey LIMIT 50")
def seeded_sample(t):
    return Wn.seeded_sample(t.customer, "c_custkey", "7", 50).select("c_custkey")


@query("""SELECT o_orderkey, round(rank() OVER (ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2, 1) AS r FROM orders""")
def rank_average(t):
    from crosslink.operators.metrics import average_ranks

    return average_ranks(t.orders, "o_totalprice", "r").select("o_orderkey", F.round("r", 1).alias("r"))


@query("""WITH i AS (SELECT o_custkey AS id, list_distinct(list(o_orderkey % 200)) AS expected, CAST('0x' || substr(sha256(CAST(o_custkey AS VARCHAR)), 1, 12) AS BIGINT) AS h
  FROM orders GROUP BY 1), p AS (SELECT c, row_number() OVER (ORDER BY sha256(CAST(c AS VARCHAR))) - 1 AS n, count(*) OVER () AS total
  FROM (SELECT DISTINCT p_partkey % 200 AS c FROM part)),
l AS (SELECT id, c, (n - h % total + total) % total AS d, len(expected) + 11 AS looks, list_contains(expected, c) AS wanted
  FROM i, p), r AS (SELECT id, c, row_number() OVER (PARTITION BY id ORDER BY d) AS r FROM l
  WHERE d < looks AND NOT wanted) SELECT id, c AS distractor FROM r WHERE r <= 3""")
def add_distractors(t):
    items = t.orders.groupBy(F.col("o_custkey").alias("id")).agg(F.collect_set(F.col("o_orderkey") % 200).alias("expected"))
    return Wn.distractors(items, t.part.select((F.col("p_partkey") % 200).alias("candidate")), 3)


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def canonical_sort(t):
    return Wn.canonical_sort(t.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_orderstatus", "o_custkey", "o_orderkey"])
