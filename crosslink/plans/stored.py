"""Sources and sinks: the tables written as files of each format and read again by the operator."""

from functools import reduce

from pyspark.sql import functions as F

from crosslink.plans import matching
from crosslink.plans.base import matched, query
from crosslink.scratch import remove_at_end, scratch
from crosslink.sources import files, lexical, sqlite
from crosslink.streaming import streams


def put(t, df, name, form="text", **options):
    """The path under which ``df`` is written in a format."""
    path = scratch(t.spark, name)
    df.write.format(form).options(**options).save(path)
    remove_at_end(t.spark, path)
    return path


def documents(t, df, name):
    """The path under which each row (value, folder) is a file of its own; a folder has one row."""
    path = scratch(t.spark, name)
    df.write.partitionBy("folder").text(path)
    remove_at_end(t.spark, path)
    return path


def filed(t, df, name):
    """The path under which each folder of ``df`` (folder, ord, value) is one file of lines in order."""
    path = scratch(t.spark, name)
    df.repartition("folder").sortWithinPartitions("folder", "ord").select("value", "folder").write.partitionBy("folder").text(path)
    remove_at_end(t.spark, path)
    return path


def rooted(t, df, name):
    """The path under which each folder of ``df`` (folder, value) is one XML document with its values, in any order, as lines below one root."""
    ends = F.explode(F.array(F.struct(F.lit(0).alias("ord"), F.lit("<root>").alias("value")), F.struct(F.lit(2).alias("ord"), F.lit("</root>").alias("value")))).alias("e")
    frame = df.select("folder").distinct().select("folder", ends).select("folder", "e.ord", "e.value")
    return filed(t, df.select("folder", F.lit(1).alias("ord"), "value").unionByName(frame), name)


def in_ranges(t):
    """A session that reads files in ranges of 8 kB, so that files of the test data have many."""
    spark = t.spark.newSession()
    for name, value in (("spark.sql.files.maxPartitionBytes", "8k"), ("spark.sql.files.openCostInBytes", "1k")):
        spark.conf.set(name, value)
    return spark


def with_state(t):
    """A session with the state store of transformWithState and, as each partition has a store of its own, as many shuffle partitions as the caller's."""
    spark, parts = t.spark.newSession(), "spark.sql.shuffle.partitions"
    for name, value in (streams.ROCKS, (parts, t.spark.conf.get(parts))):
        spark.conf.set(name, value)
    return spark


def folder_of(path="path"):
    """The folder's number in a path."""
    return F.regexp_extract(path, "folder=([0-9]+)", 1).cast("long").alias("folder")


def joined(column):
    """The texts of a group in order. A group is one file of the test data; there are more files where there is more data."""
    return F.array_join(F.array_sort(F.collect_list(column)), "")


def stream(t, df, name, session=None):
    """``df`` as a stream of its files, one a batch at least; ``session``: the one that reads it."""
    path = put(t, df, name, "parquet")
    return (session or t.spark).readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(path)


def ticking(t, df, name, at, session=None):
    """``df`` in eight files in no order of time, read two a batch, and at last a row far in the future, which moves the watermark beyond all others."""
    path = put(t, df.repartition(8, F.xxhash64(*df.columns)), name, "parquet")
    tick = df.limit(1).select(*[F.to_timestamp_ntz(F.lit("2100-01-01 00:00:00")).alias(c) if c == at else F.lit(None).cast(kind).alias(c) for c, kind in df.dtypes])
    tick.write.mode("append").parquet(path)
    return (session or t.spark).readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(path)


def drained(t, df, name):
    """All that a stream gives for the files that are there, as a table."""
    path, at = scratch(t.spark, name), scratch(t.spark, "progress")
    df.writeStream.format("parquet").option("path", path).option("checkpointLocation", at).trigger(availableNow=True).start().awaitTermination()
    for p in (path, at):
        remove_at_end(t.spark, p)
    return t.spark.read.schema(df.schema).parquet(path)


@query("SELECT count(*) AS lines, CAST(sum(octet_length(encode(x)) + 1) AS BIGINT) AS bytes, true AS hashed FROM (SELECT o_orderkey || ' ' || o_orderstatus AS x FROM orders)")
def scan_files(t):
    """The files that orders are written to: their bytes in all, and a digest for each."""
    lines = t.orders.select(F.concat_ws(" ", F.col("o_orderkey").cast("string"), "o_orderstatus").alias("value"))
    path = put(t, lines, "text")
    found = files.scan_files(t.spark, path, "*.txt").agg(F.sum("length").cast("long").alias("bytes"), F.bool_and(F.length("sha256") == 64).alias("hashed"))
    count = t.spark.read.text(path).agg(F.count("*").alias("lines"))
    return count.withColumn("one", F.lit(1)).join(found.withColumn("one", F.lit(1)), "one").drop("one")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def scan_jsonl(t):
    """Customers as zipped lines of JSON with more fields than are read."""
    path = put(t, t.customer, "json", "json", compression="gzip")
    return files.scan_jsonl(t.spark, path, "c_custkey long, c_name string, c_acctbal double")


@query("""SELECT folder, line FROM (SELECT c_custkey, c_custkey // 1000 AS folder, row_number() OVER (PARTITION BY c_custkey // 1000
  ORDER BY c_custkey) AS line FROM customer) WHERE c_custkey % 10 = 0""")
def bad_json_lines(t):
    """Files of a thousand lines, read in ranges; the numbers of the broken lines."""
    line = F.when(F.col("c_custkey") % 10 == 0, "{broken").otherwise(F.to_json(F.struct("c_custkey")))
    path = filed(t, t.customer.select(F.floor(F.col("c_custkey") / 1000).alias("folder"), F.col("c_custkey").alias("ord"), line.alias("value")), "json")
    return files.bad_json_lines(in_ranges(t), path, "c_custkey long").select(folder_of(), "line")


@query("SELECT o_orderkey, o_custkey FROM orders")
def scan_donor(t):
    return files.scan_table(t.spark, put(t, t.orders, "donor", "parquet"), ["o_orderkey", "o_custkey"]).select("o_orderkey", "o_custkey")


def sqlite_files(t, df, table):
    """The folder in which each of four tasks has written its rows to a table of a SQLite file of its own."""
    path, names = scratch(t.spark, "donor"), df.columns
    remove_at_end(t.spark, path)
    folder = sqlite.local(path)

    def write(batches):
        import os
        import sqlite3
        import uuid

        import pandas as pd

        os.makedirs(folder, exist_ok=True)
        file, n = f"{folder}/{uuid.uuid4().hex}", 0
        db = sqlite3.connect(f"{folder}/.{os.path.basename(file)}")
        db.execute(f"CREATE TABLE {table} (o_orderkey INTEGER, o_custkey INTEGER, o_orderstatus TEXT, o_totalprice REAL)")
        for batch in batches:
            db.executemany(f"INSERT INTO {table} VALUES (?, ?, ?, ?)", batch[names].astype(object).values.tolist())
            n += len(batch)
        db.commit()
        db.close()
        os.rename(f"{folder}/.{os.path.basename(file)}", file)
        yield pd.DataFrame({"n": [n]})

    df.repartition(4, names[0]).mapInPandas(write, "n long").agg(F.sum("n")).collect()
    return path


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000")
def scan_sqlite(t):
    """Orders in SQLite files, read in ranges of two thousand rows; the database filters them."""
    session = t.spark.newSession()
    session.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    path = sqlite_files(t, t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), "orders")
    rows = sqlite.scan_sqlite(session, path, "orders", partition_rows=2000).filter("o_orderstatus = 'F' and o_totalprice > 1000")
    return rows.select("o_orderkey", "o_custkey", "o_totalprice")


@query("SELECT event_id // 2000 AS folder, row_number() OVER (PARTITION BY event_id // 2000 ORDER BY event_id) - 1 AS sample_index, CAST(event_id AS DOUBLE) AS id, round(value, 2) AS value, CAST(user_id AS DOUBLE) AS user FROM events")
def scan_samples(t):
    """Files of two thousand events, read in ranges, with a blank line before every seventh."""
    line = F.concat_ws("  ", F.col("event_id").cast("string"), F.round("value", 2).cast("string"), F.col("user_id").cast("string"))
    rows = t.events.select(F.floor(F.col("event_id") / 2000).alias("folder"), F.col("event_id").alias("ord"), F.when(F.col("event_id") % 7 == 0, F.concat(F.lit(" \n"), line)).otherwise(line).alias("value"))
    return files.scan_samples(in_ranges(t), filed(t, rows, "samples"), ["id", "value", "user"], "*.txt").select(folder_of(), "sample_index", "id", "value", "user")


@query("""SELECT 3 * (vec_id // 300) + vec_id % 3 AS folder, row_number() OVER (PARTITION BY vec_id // 300, vec_id % 3
  ORDER BY vec_id) - 1 AS line, round(v[1] + v[2] + v[3], 6) AS total, round(v[1] + v[3], 6) AS without_second
  FROM (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings)""")
def scan_channels(t):
    """Channels of vectors as lines of CSV, in three orders of columns with an id between; their sum, and that without the second one."""
    v, k = F.col("embedding").cast("array<double>"), F.col("vec_id")
    number = (3 * F.floor(k / 300) + k % 3).alias("folder")
    cell = lambda i: v[i - 1].cast("string") if i else k.cast("string")
    orders = ((3, 1, 0, 2), (0, 1, 2, 3), (2, 3, 1, 0))
    chosen = lambda rows: reduce(lambda e, i: e.when(k % 3 == i, rows[i]), range(1, 3), F.when(k % 3 == 0, rows[0]))
    lines = t.embeddings.select(number, k.alias("ord"), chosen([F.concat_ws(",", *map(cell, o)) for o in orders]).alias("value"))
    heads = t.embeddings.select(number, F.lit(-1).cast("long").alias("ord"), chosen([F.lit(",".join(f"L{i}" if i else "id" for i in o)) for o in orders]).alias("value")).distinct()
    spark, path = in_ranges(t), filed(t, lines.unionByName(heads), "channels")
    total = lambda name, **how: files.scan_channels(spark, path, r"L([0-9]+)", range(1, 4), **how).select(folder_of(), "line", F.round("total", 6).alias(name))
    return total("total").join(total("without_second", drop=2), ["folder", "line"])


@query(r"SELECT page_id, regexp_extract(url, '^(https?)://([^/]+)/([^?]*)', 2) AS host, regexp_extract(url, '^(https?)://([^/]+)/([^?]*)', 3) AS rest FROM pages WHERE regexp_matches(url, '^https://[^/]+/')")
def decompose_paths(t):
    out = files.decompose_paths(t.pages.select("page_id", "url"), "url", r"^(https?)://([^/]+)/([^?]*)", ["scheme", "host", "rest"], {"scheme": ["https"]})
    return out.select("page_id", "host", "rest")


@query("SELECT c_custkey, c_nationkey FROM customer")
def write_table(t):
    path = scratch(t.spark, "table")
    files.write_table(t.customer.select("c_custkey", "c_nationkey"), path, lambda df: df.filter("c_custkey is null"))
    remove_at_end(t.spark, path)
    return t.spark.read.parquet(path)


@query("SELECT o_orderkey, o_orderkey * 2 AS doubled, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 2 END AS run FROM orders")
def resume_checkpoint(t):
    """A third of the orders is processed in a first run, the rest in a second one, which is given all of them."""
    path = scratch(t.spark, "resumed")
    work = lambda run: lambda df: df.select("o_orderkey", (F.col("o_orderkey") * 2).alias("doubled"), F.lit(run).alias("run"))
    files.resume(t.orders.filter("o_orderkey % 3 = 0"), path, "o_orderkey", work(1))
    out = files.resume(t.orders, path, "o_orderkey", work(2))
    remove_at_end(t.spark, path)
    return out


@query("SELECT count(*) AS attempted, CAST(count_if(length(text) <= 1000) AS BIGINT) AS completed, CAST(count_if(length(text) > 1000) AS BIGINT) AS failed FROM documents WHERE text IS NOT NULL")
def dead_letter(t):
    rows = t.documents.filter("text is not null").withColumn("error", F.when(F.length("text") > 1000, F.col("text")))
    return files.dead_letter(rows, "error")[2]


@query("""SELECT doc_id, CASE WHEN length(text) % 7 = 0 THEN 'ZeroDivisionError' ELSE 'KeyError' END AS error_type,
  CASE WHEN length(text) % 7 = 0 THEN 'division by zero' ELSE chr(39) || lang || chr(39) END AS error_message FROM documents
  WHERE length(text) % 7 = 0 OR lang <> 'en'""")
def failed_rows(t):
    """Rows whose processing raised, from the side table, with the type and the message of the error."""
    sizes = {"en": 1}
    tried = files.attempt(t.documents.select("doc_id", "text", "lang"), lambda r: {"share": len(r["text"]) / (len(r["text"]) % 7) / sizes[r["lang"]]}, "share double")
    path = scratch(t.spark, "failed")
    remove_at_end(t.spark, path)
    files.dead_letter(tried, "error_message", path=path, keys=["doc_id", "error_type"])
    return t.spark.read.schema("doc_id long, error_type string, error_message string").json(path)


def xml_files(t):
    """Parts as files of a hundred rolesets."""
    n = F.col("p_size") % 4
    roles = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.lit('<role n="'), i.cast("string"), F.lit('" f="PAG" descr="d"/>')))
    inner = F.when(n > 0, F.array_join(roles, "")).otherwise("")
    one = F.concat(F.lit('<roleset id="p'), F.col("p_partkey").cast("string"), F.lit('.01" name="'), "p_type", F.lit('"><roles>'), inner, F.lit("</roles></roleset>"))
    folder = F.floor(F.col("p_partkey") / 100).alias("folder")
    whole = t.part.groupBy(folder).agg(joined(one).alias("all"))
    return documents(t, whole.select(F.concat(F.lit('<frameset><predicate lemma="x">'), "all", F.lit("</predicate></frameset>")).alias("value"), "folder"), "rolesets")


@query("SELECT 'p' || p_partkey || '.01' AS roleset_id, p_type AS name, 'x' AS lemma FROM part")
def scan_rolesets(t):
    return lexical.scan_rolesets(t.spark, xml_files(t), "*.txt").select("roleset_id", "name", "lemma")


#: Of files of a hundred parts every seventh lacks a quote, every third of these has a repair, every fifth of these is bound to another file.
ROLESET_FILES = """f AS (SELECT p_partkey // 20 AS folder, count(*) AS n FROM part GROUP BY 1),
o AS (SELECT folder, n, CASE WHEN folder % 7 = 0 THEN CASE WHEN folder % 3 > 0 THEN 'invalid_xml' WHEN folder % 5 = 0 THEN 'wrong_file' ELSE 'repaired' END WHEN folder % 11 = 0 THEN 'not_needed' ELSE 'parsed' END AS outcome
  FROM f)"""


def repaired_files(t):
    k = F.col("p_partkey")
    folder = F.floor(k / 20).alias("folder")
    one = F.concat(F.lit('<roleset id="p'), k.cast("string"), F.lit('.01" name="'), "p_type", F.lit('"/>'))
    whole = t.part.groupBy(folder).agg(joined(one).alias("all"))
    head = lambda broken: F.concat(F.lit('<frameset><predicate lemma="x"><note src='), F.lit("A & B" if broken else '"A &amp; B"'), F.lit("/>"))
    text = F.concat(F.when(F.col("folder") % 7 == 0, head(True)).otherwise(head(False)), "all", F.lit("</predicate></frameset>"))
    path = documents(t, whole.select(text.alias("value"), "folder"), "rolesets")
    names = files.whole_texts(t.spark, path, "*.txt").select(F.col("path").alias("relative_path"), "text", folder_of("path"))
    declared = names.filter("(folder % 7 = 0 and folder % 3 = 0) or (folder % 7 > 0 and folder % 11 = 0)")
    sha = F.when((F.col("folder") % 5 == 0) & (F.col("folder") % 7 == 0), F.lit("0")).otherwise(F.sha2("text", 256))
    repairs = declared.select(F.col("folder").cast("string").alias("repair_id"), "relative_path", sha.alias("source_file_sha256"), F.lit("src=A & B/>").alias("old_fragment"), F.lit('src="A &amp; B"/>').alias("replacement_fragment"))
    return lexical.project_rolesets(t.spark, path, "*.txt", repairs)


@query(f"WITH {ROLESET_FILES} SELECT folder, outcome, CASE WHEN outcome IN ('invalid_xml', 'wrong_file') THEN 0 ELSE n END AS rolesets, outcome = 'repaired' AS changed FROM o")
def roleset_repairs(t):
    """Every file with what came of it and its repair, and how many rolesets it gave."""
    tables = repaired_files(t)
    n = tables["rolesets"].groupBy("path").agg(F.count("roleset_id").alias("n"))
    return tables["files"].join(n, "path", "left").select(folder_of("path"), "outcome", F.coalesce("n", F.lit(0).cast("long")).alias("rolesets"), F.coalesce(F.col("repaired_sha256") != F.col("original_sha256"), F.lit(False)).alias("changed"))


@query("SELECT 'p' || p_partkey || '.01' AS id, CAST(unnest(range(1, p_size % 4 + 1)) AS VARCHAR) AS number FROM part")
def roleset_arguments(t):
    return lexical.roleset_arguments(lexical.scan_rolesets(t.spark, xml_files(t), "*.txt")).select("id", F.col("number").cast("string").alias("number"))


@query("SELECT 'p' || p_partkey || '.01' AS roleset_id FROM part")
def scan_roleset_ids(t):
    return lexical.scan_roleset_ids(t.spark, xml_files(t), "*.txt")[0].select("roleset_id")


@query("SELECT DISTINCT 'S' || c_custkey AS symbol FROM customer UNION SELECT 'N' || c_nationkey FROM customer UNION SELECT 'subclass'")
def scan_symbols(t):
    """Customers as formulas with a variable, a comment and a string, which are no symbols."""
    text = F.concat(F.lit("(subclass S"), F.col("c_custkey").cast("string"), F.lit(" N"), F.col("c_nationkey").cast("string"), F.lit(' ?X "quoted") ; said'))
    return lexical.scan_symbols(t.customer.select(text.alias("text")))


@query("""SELECT folder, n AS formula_index, 2 * n - 1 AS start_line, 'S' || c_custkey AS child, 'N' || c_nationkey AS parent
  FROM (SELECT *, c_custkey // 700 AS folder, row_number() OVER (PARTITION BY c_custkey // 700 ORDER BY c_custkey) AS n FROM customer) WHERE c_custkey % 2 = 0""")
def scan_axioms(t):
    """Files of seven hundred formulas of two lines, read in ranges that cut formulas, strings and comments."""
    k = F.col("c_custkey")
    line = F.concat(F.when(k % 2 == 0, "(subclass S").otherwise('(other "( a ""string S'), k.cast("string"), F.when(k % 2 == 0, "\n  N").otherwise('\n ((" N'), F.col("c_nationkey").cast("string"), F.lit(') ; a (comment "'))
    path = filed(t, t.customer.select(F.floor(k / 700).alias("folder"), k.alias("ord"), line.alias("value")), "axioms")
    formulas = lexical.scan_axioms(in_ranges(t), path, "*.txt").filter("head = 'subclass' and size(parts) = 2")
    return formulas.withColumnRenamed("module", "path").select(folder_of(), "formula_index", "start_line", F.col("parts")[0].alias("child"), F.col("parts")[1].alias("parent"))


FRAMES = """fr AS (SELECT n_nationkey AS frame_id, n_name AS name
  FROM nation), fe AS (SELECT c_custkey AS fe_id, c_nationkey AS frame_id, c_name AS name,
  CASE WHEN c_custkey % 3 = 0 THEN 'Peripheral' ELSE 'Core' END AS core_type, c_custkey % 4 = 0 AS typed FROM customer)"""


def frames(t):
    """Nations as frames of one file each, their customers as frame elements."""
    k = F.col("c_custkey")
    sem = F.when(k % 4 == 0, F.concat(F.lit('<semType ID="'), (k % 9).cast("string"), F.lit('" name="t"/>'))).otherwise("")
    element = F.concat(F.lit('<FE ID="'), k.cast("string"), F.lit('" name="'), "c_name", F.lit('" coreType="'), F.when(k % 3 == 0, "Peripheral").otherwise("Core"), F.lit('">'), sem, F.lit("</FE>"))
    inner = t.customer.groupBy("c_nationkey").agg(joined(element).alias("all"))
    whole = t.nation.join(inner, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    line = F.concat(F.lit('<frame ID="'), F.col("n_nationkey").cast("string"), F.lit('" name="'), "n_name", F.lit('">'), F.coalesce("all", F.lit("")), F.lit("</frame>"))
    path = documents(t, whole.select(line.alias("value"), F.col("n_nationkey").alias("folder")), "frames")
    return lexical.frames_or_fail(lexical.scan_frames(t.spark, f"{path}/*", "*.txt"))


@query(f"WITH {FRAMES} SELECT fr.frame_id, fr.name, count(fe_id) AS n_elements FROM fr LEFT JOIN fe USING (frame_id) GROUP BY 1, 2")
def scan_frames(t):
    found = frames(t)
    n = found["fes"].groupBy("frame_id").agg(F.count("*").alias("n"))
    return found["frames"].join(n, "frame_id", "left").select("frame_id", "name", F.coalesce("n", F.lit(0)).alias("n_elements"))


@query(f"WITH {FRAMES} SELECT fe_id, frame_id, name, core_type, typed FROM fe")
def frame_elements(t):
    found = frames(t)
    typed = found["sem_types"].filter("kind = 'fe'").select(F.col("owner_id").alias("fe_id"), F.lit(True).alias("typed")).distinct()
    return found["fes"].join(typed, "fe_id", "left").select("fe_id", "frame_id", "name", "core_type", F.coalesce("typed", F.lit(False)).alias("typed"))


@query("SELECT o_orderkey AS relation_id, o_custkey AS sub_id, o_orderkey % 97 AS super_id, 'outgoing' AS direction FROM orders UNION ALL SELECT o_orderkey, o_orderkey % 97, o_custkey, 'incoming' FROM orders")
def scan_frame_relations(t):
    """Orders as frame relations in files of 50,000 keys, with a relation type for each priority and 500 keys."""
    k = F.col("o_orderkey")
    one = F.concat(F.lit('<frameRelation ID="'), k.cast("string"), F.lit('" subID="'), F.col("o_custkey").cast("string"), F.lit('" supID="'), (k % 97).cast("string"), F.lit('"/>'))
    block = F.floor(k / 500).alias("block")
    lines = t.orders.groupBy("o_orderpriority", block).agg(joined(one).alias("all"))
    line = F.concat(F.lit('<frameRelationType ID="'), F.left("o_orderpriority", F.lit(1)), F.lit('" name="x">'), "all", F.lit("</frameRelationType>"))
    path = rooted(t, lines.select(F.floor(F.col("block") / 100).alias("folder"), line.alias("value")), "relations")
    found = lexical.scan_frame_relations(t.spark, f"{path}/*")["relations"]
    return found.select("relation_id", "sub_id", "super_id", "direction")


@query("SELECT s_suppkey AS id, s_name AS name, 'frame' AS kind FROM supplier UNION ALL SELECT p_partkey, p_name, 'lu' FROM part")
def scan_indexes(t):
    attribute = lambda c: F.concat(F.lit('"'), c.cast("string"), F.lit('"'))
    frame = F.concat(F.lit("<frame ID="), attribute(F.col("s_suppkey")), F.lit(" name="), attribute(F.col("s_name")), F.lit("/>"))
    lu = F.concat(F.lit("<lu ID="), attribute(F.col("p_partkey")), F.lit(" name="), attribute(F.col("p_name")), F.lit(' frameID="1" status="x"/>'))
    paths = [rooted(t, df.select(F.floor(F.col(key) / 50000).alias("folder"), one.alias("value")), name) for df, key, one, name in ((t.supplier, "s_suppkey", frame, "frame-index"), (t.part, "p_partkey", lu, "lu-index"))]
    found = lexical.scan_indexes(t.spark, *[f"{p}/*" for p in paths])
    return found["frames"].select("id", "name", F.lit("frame").alias("kind")).unionByName(found["lus"].select("id", "name", F.lit("lu").alias("kind")))


@query("SELECT event_id AS record_id FROM events")
def stream_reviews(t):
    """Each event twice, as a stream of reviews: each comes once."""
    rows = t.events.select(F.col("event_id").alias("record_id"), "ts")
    return drained(t, streams.distinct_reviews(stream(t, rows.unionByName(rows), "reviews"), "ts", "4000 days").select("record_id"), "reviews-once")


@query("SELECT event_id AS record_id, true AS before FROM events")
def stream_append_reviews(t):
    """Each event twice as a stream of reviews over two runs and many batches; between the runs the last batch is run again, a batch fails before its commit, and old reviews come again long after the watermark. Each review stands in the table once."""
    rows = t.events.select(F.col("event_id").alias("record_id"), "ts")
    path, out, at = put(t, rows.unionByName(rows).repartition(4, F.xxhash64("record_id", "ts"), F.rand(7)), "reviews", "parquet"), scratch(t.spark, "reviews-once"), scratch(t.spark, "progress")
    run = lambda: streams.append_reviews(t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path), "ts", out, at, "4000 days").awaitTermination()
    for p in (out, f"{out}.ledger", at):
        remove_at_end(t.spark, p)
    run()
    last = streams.committed_batches(t.spark, out).agg(F.max("batch").alias("last")).first()["last"]
    was = streams.read_reviews(t.spark, out).drop("batch")
    streams.commit_batch(rows, last, out)  # a batch that is run again
    rows.write.parquet(f"{out}/batch={last + 1}")  # one that failed before its commit
    rows.withColumn("ts", F.col("ts") + F.expr("INTERVAL 30 YEARS")).write.mode("append").parquet(path)  # beyond the watermark
    run()
    return streams.read_reviews(t.spark, out).join(was.select("record_id", F.lit(True).alias("before")), "record_id", "left").select("record_id", "before")


@query(f"WITH {matching.MAPPINGS} SELECT * FROM cross_")
def stream_crosswalk(t):
    """Mappings that arrive in files, joined to the static comparisons."""
    rows = streams.stream_crosswalk(stream(t, matching.mappings(t).repartition(6), "mappings"), matched(t), "MACHINERY")
    return drained(t, rows, "crosswalk")


@query("""SELECT user_id, CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS start, count(*) AS n, round(avg(value), 6) AS mean,
  CASE WHEN avg(value) >= 60 THEN 'contact' WHEN avg(value) <= 40 THEN 'no_contact' ELSE 'refused' END AS prediction FROM events
  GROUP BY user_id, date_trunc('day', ts)""")
def stream_window_features(t):
    """All days, over several batches of files in no order of time."""
    features = streams.window_features(ticking(t, t.events, "events", "ts"), ["user_id"], "ts", "value", 50.0, 10.0, delay="4000 days")
    return drained(t, features, "features").select("user_id", F.unix_timestamp("start").alias("start"), "n", F.round("mean", 6).alias("mean"), "prediction")


@query("""WITH o AS (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before
  FROM events), s AS (SELECT user_id, ts, sum(CASE WHEN before IS NULL OR ts - before >= INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id
  ORDER BY ts) AS s FROM o)
SELECT user_id, CAST(floor(epoch(min(ts))) AS BIGINT) AS start, count(*) AS n FROM s GROUP BY user_id, s""")
def stream_gaps(t):
    """All sessions, which grow over several batches of files in no order of time."""
    out = drained(t, streams.sessions(ticking(t, t.events, "events", "ts"), ["user_id"], "ts", "6 hours", "4000 days"), "sessions")
    return out.select("user_id", F.unix_timestamp("start").alias("start"), "n")


@query("""SELECT CAST(user_id AS VARCHAR) AS key, CAST(floor(epoch(ts)) AS BIGINT) AS start, first, second
  FROM (SELECT user_id, ts, event_type AS first, lead(event_type) OVER w AS second, lead(ts) OVER w AS until
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE until - ts <= INTERVAL 20 DAY""")
def stream_alternation(t):
    """Events of a user in pairs, from batches of files in no order of time; the last event waits in the state until the next one comes."""
    rows = streams.alternation(ticking(t, t.events, "events", "ts", with_state(t)), "user_id", "ts", "event_type", "event_id", "4000 days", "20 days")
    return drained(t, rows, "pairs").select("key", F.unix_timestamp("start").alias("start"), "first", "second")
