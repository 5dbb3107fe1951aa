import hashlib

from pyspark.sql import functions as F

from crosslink.functions import ids, texts, values


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def test_ids(spark):
    lit = F.lit
    got = one(
        spark, *[ids.normal_sense_id(lit(x)) for x in ("abandon-01", "a-b-02", "abandon.01", "x-1", "-01", "abandon-01\n")],
        ids.strip_argument(lit("a.01:ARG1"), lit("propbank"), "propbank"), ids.strip_argument(lit("a.01:ARG1"), lit("sumo"), "propbank"), ids.strip_argument(lit("plain"), lit("propbank"), "propbank"),
        ids.argument_number(lit("ARG07")), ids.argument_number(lit("ARGM")), ids.type_id(lit("sumo:Entity")),
    )
    assert got == ("abandon.01", "a-b.02", None, None, None, None, "a.01", "a.01:ARG1", "plain", "7", None, "lc:sumo_type.entity")
    assert one(spark, ids.stable_id("x_", lit("a"), lit(None).cast("string"), lit("b")))[0] == "x_" + hashlib.sha256(b"a\0\0b").hexdigest()[:24]
    assert one(spark, ids.json_id("j_", b=lit('q"\\'), a=lit(None).cast("string")))[0] == "j_" + hashlib.sha256(b'{"a":null,"b":"q\\"\\\\"}').hexdigest()
    assert one(spark, ids.blob_sha(lit("hello\n")))[0] == "ce013625030ba8dba906f756967f9e9ca394464a"
    checks = [ids.is_hex(lit("0af"), 3), ids.is_hex(lit("0AF"), 3), ids.is_version(lit("1.0.2-neg")), ids.is_version(lit("1.02.0")), ids.is_safe_path(lit("a/b.xml")), ids.is_safe_path(lit("../b")), ids.is_safe_path(lit("/b")), ids.is_basename(lit("a/b")), ids.is_token(lit("a:b"))]
    assert one(spark, *checks) == (True, False, True, False, True, False, False, False, True)
    times = [ids.utc_seconds(lit(x)).isNotNull() for x in ("2024-01-02T03:04:05Z", "2024-01-02T03:04:05+02:00", "2024-01-02T03:04:05", "2024-01-02T03:04:05.5Z", "2024-13-02T03:04:05Z")]
    assert one(spark, *times) == (True, True, False, False, False)


def test_texts(spark):
    lit = F.lit
    assert one(spark, texts.occurrences(lit("aaaa"), lit("aa")), texts.occurrences(lit("x"), lit("")), texts.only_place(lit("abc"), lit("c")), texts.only_place(lit("cc"), lit("c"))) == (2, 0, 2, None)
    quote = lambda f, q: texts.grounded_quote(F.create_map(lit("d"), lit("one two two")), lit(f), lit(q))
    assert [tuple(x) for x in one(spark, quote("d", "one"), quote("d", "two"), quote("d", "six"), quote("e", "one"), quote("d", ""))] == [("grounded", 0, 3), ("ambiguous", None, None), ("not_found", None, None), ("missing_field", None, None), ("empty_quote", None, None)]
    kind = lambda t, ok=False: texts.header_class(lit(t), lit(ok), ["Example grants", "prepare derivative works"])
    own = "EXAMPLE GRANTS the right to\r\nprepare derivative works; GNU General Public License"
    assert one(spark, kind("GNU General Public License"), kind("gnu lesser general public license"), kind("GNU General Public License, Create Commons"), kind("Creative Commons", True)) == ("gpl", "lgpl", "mixed", "cc")
    assert one(spark, kind(own, True), kind(own), kind("x\r" * 120 + "gnu public license"), kind("x\r\n" * 119 + "gnu public license"), kind("LGPL")) == ("approved_notice", "gpl", "unclassified", "gpl", "unclassified")
    text = lit("a<b")
    sha = lambda x: lit(hashlib.sha256(x).hexdigest())
    assert one(spark, texts.repaired(text, lit("<"), lit("&lt;"), sha(b"a<b")), texts.repaired(text, lit("<"), lit("&lt;"), sha(b"other"))) == ("a&lt;b", None)
    assert one(spark, texts.line_range(lit("a\nb \nc"), 2, 3), texts.line_range(lit("a"), 1, 2), texts.redacted(lit("my key key"), ["key"], 8), texts.repaired(lit("a<b"), lit("<"), lit("&lt;"))) == ("b\nc", None, "my [reda", "a&lt;b")
    roles = texts.without_empty_roles(F.create_map(*[lit(x) for x in ("a", " ", "b", "unknown", "c", "Unknown", "d", "n/a ", "e", "x")]))
    assert one(spark, roles)[0] == {"c": "Unknown", "e": "x"}
    assert one(spark, texts.missing_phrases(lit("a b"), ["a", "c"]), texts.tagged_json(lit("<t>{1}\n</t><t>2</t>"), "t"), texts.same_shape(lit("First of all"), lit("x")), texts.same_shape(lit("someone"), lit("x"))) == (["c"], ["{1}\n", "2"], True, False)


def test_values(spark):
    lit, arr = F.lit, lambda *x: F.array(*[F.lit(float(v)) for v in x])
    v = arr(1, 2, 3)
    assert one(spark, values.magnitude(arr(3, 4)), values.rotated(v, "x90"), values.rotated(v, "y90"), values.rotated(v, "z90")) == (5.0, [1.0, -3.0, 2.0], [3.0, 2.0, -1.0], [-2.0, 1.0, 3.0])
    bands = [values.band(lit(x), lit(0.5), lit(0.25)) for x in (0.75, 0.25, 0.5)]
    assert one(spark, *bands, values.band(lit(None).cast("double"), lit(0.5), lit(0.25))) == ("contact", "no_contact", "refused", "refused")
    assert one(spark, *[values.two_rules(lit(a), lit(b)) for a, b in ((True, False), (False, True), (True, True), (False, False))]) == ("static", "dynamic", "refused", "refused")
    m = lambda **k: F.create_map(*[lit(x) for kv in k.items() for x in kv])
    same = values.participants_match
    assert one(spark, same(m(a="x", b="y"), m(b="y", a="x"), m(q="r")), same(m(a="x"), m(c="x"), m(a="c")), same(m(c="x"), m(a="x"), m(a="c")), same(m(a="x"), m(c="y"), m(a="c"))) == (True, True, True, False)
    assert one(spark, values.interchanged(m(a="z", b="y", c="q"), lit("a"), lit("b")), values.interchanged(m(a="z"), lit("a"), lit("b"))) == ({"a": "y", "b": "z", "c": "q"}, {"a": "z"})
    assert one(spark, values.clipped(lit(95.0), lit(5.0), lit(95.0)), values.clipped(lit(1.0), lit(5.0), lit(5.0)), values.sorted_unique(F.array(lit(1), lit(2))), values.sorted_unique(F.array(lit(2), lit(2))), values.in_trial(lit(-1e-7), lit(3.0)), values.event_time(lit(2.5), lit(50.0), lit(100.0))) == (1.0, None, True, False, True, 2.0)


def test_exact_mean(spark):
    """Means do not depend on the order of rows; sums of doubles here do (0.1 ten times is less than 1)."""
    mean = lambda *x: spark.createDataFrame([(v,) for v in x], "v double").coalesce(1).agg(values.exact_mean(F.col("v")).alias("m")).first().m
    assert mean(*[0.1] * 10) == 0.1 and mean(1e16, 0.25, -1e16, None, 0.25) == 0.125
    assert mean() is None and mean(None) is None and mean(float("nan"), 1.0) != mean(1.0) and mean(float("inf"), 1.0) == float("inf")
    assert mean(1e300, 3e300) == 2e300 and mean(1e-30, 3e-30) == 2e-30 and mean(9e19, 9e19) == 9e19
