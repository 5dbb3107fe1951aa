import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from crosslink.plans import QUERIES
from crosslink.sources import files, lexical


def put(root, **texts):
    for name, text in texts.items():
        (root / name.replace("__", ".")).write_text(text)
    return str(root)


def test_scan_files(spark, tmp_path):
    root = put(tmp_path, a__txt="one", b__txt="two", c__xml="x")
    got = {r.path: (r.length, r.sha256) for r in files.scan_files(spark, root, "*.txt").collect()}
    assert got == {"a.txt": (3, hashlib.sha256(b"one").hexdigest()), "b.txt": (3, hashlib.sha256(b"two").hexdigest())}
    with pytest.raises(ValueError):
        files.scan_files(spark, root, "*.kif")


def test_jsonl(spark, tmp_path):
    with gzip.open(tmp_path / "a.json.gz", "wt") as f:
        f.write('{"a": 1, "more": 2}\n{"a": 2}\n')
    assert [r.a for r in files.scan_jsonl(spark, str(tmp_path / "a.json.gz"), "a int").orderBy("a").collect()] == [1, 2]
    put(tmp_path, b__json='{"a": 1}\nnot json\n{"a": "x"}\n')
    assert [r.line for r in files.bad_json_lines(spark, str(tmp_path / "b.json"), "a int").orderBy("line").collect()] == [2, 3]
    with pytest.raises(Exception):
        files.scan_jsonl(spark, str(tmp_path / "b.json"), "a int").collect()


def test_samples_and_channels(spark, tmp_path):
    (tmp_path / "s").mkdir()
    root = put(tmp_path / "s", acc__txt="1 2 3\n4 5 6\n\n 7  8 x\n")
    got = [tuple(r)[1:] for r in files.scan_samples(spark, root, ["x", "y", "z"]).orderBy("sample_index").collect()]
    assert got == [(0, 1.0, 2.0, 3.0), (1, 4.0, 5.0, 6.0), (2, 7.0, 8.0, None)]
    (tmp_path / "c").mkdir()
    root = put(tmp_path / "c", t__csv="time,L2,L1\n0,1.5,2\n1,nan,1\n2,4,4\n")
    scan = lambda **k: [r.total for r in files.scan_channels(spark, root, r"L([0-9]+)", range(1, 3), **k).orderBy("line").collect()]
    assert scan() == scan(reverse=True) == [3.5, None, 8.0] and scan(drop=2) == [2.0, None, 4.0]
    with pytest.raises(ValueError):
        files.scan_channels(spark, root, r"L([0-9]+)", range(1, 4))


def test_paths(spark):
    df = spark.createDataFrame([("P01/S1_run_01.csv",), ("P02/S1_walk_02.c3d",), ("bad",)], "path string")
    got = files.decompose_paths(df, "path", r"^(P[0-9]+)/S([0-9])_([a-z]+)_([0-9]+)\.([a-z0-9]+)$", ["person", "session", "area", "trial", "ext"], {"area": ["run"]})
    assert [tuple(r)[1:] for r in got.collect()] == [("P01", "1", "run", "01", "csv")]
    assert [r.path for r in files.excluded_paths(df, df.filter("path = 'bad'")).collect()] == ["P01/S1_run_01.csv", "P02/S1_walk_02.c3d"]


def test_write_resume_dead_letter(spark, tmp_path):
    df, path = spark.range(5), str(tmp_path / "t")
    files.write_table(df, path)
    assert spark.read.parquet(path).count() == 5 and files.scan_table(spark, path, ["id"]).count() == 5
    with pytest.raises(FileExistsError):
        files.write_table(df, path)
    with pytest.raises(ValueError):
        files.write_table(df, str(tmp_path / "u"), lambda x: x.filter("id = 3"))
    with pytest.raises(ValueError):
        files.scan_table(spark, path, ["id", "name"])
    assert not (tmp_path / "u").exists()
    seen, at = [], str(tmp_path / "ck")
    work = lambda d: (seen.append(d.count()), d.withColumn("out", F.col("id") * 2))[1]
    assert files.resume(df.filter("id < 3"), at, "id", work).count() == 3
    assert files.resume(df.unionByName(df), at, "id", work).count() == 5 and seen == [3, 2]
    good, bad, n = files.dead_letter(df.withColumn("error", F.when(F.col("id") > 2, F.repeat(F.lit("e"), 3000))), "error")
    assert good.columns == ["id"] and good.count() == 3 and {len(r.error) for r in bad.collect()} == {2000} and tuple(n.first()) == (5, 3, 2)


def test_errors_are_rows(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i == 4 else str(i)) for i in range(6)], "id long, text string")

    def process(row):
        if row["id"] == 2:
            raise KeyError("x" * 3000)
        return {"half": 6 / int(row["text"]), "more": [row["text"]]}

    tried = files.attempt(df, process, "half double, more array<string>")
    got = {r.id: (r.half, r.more, r.error_type, len(r.error_message or "")) for r in tried.collect()}
    assert got[3] == (2.0, ["3"], None, 0) and got[0][2] == "ZeroDivisionError" and got[2][:3] == (None, None, "KeyError") and got[2][3] == 2000 and got[4][2] == "TypeError"
    side, seen = str(tmp_path / "side"), spark.sparkContext.accumulator(0)

    def counted(row):
        seen.add(1)
        return process(row)

    good, bad, n = files.dead_letter(files.attempt(df, counted, "half double, more array<string>"), "error_message", path=side, keys=["id", "error_type"])
    assert tuple(n.first()) == (6, 3, 3) and good.count() == bad.count() == 3 and seen.value == 6  # worked out once
    files.dead_letter(tried.filter("id = 0"), "error_message", path=side, keys=["id", "error_type"])
    assert sorted((r.id, r.error_type) for r in spark.read.json(side).collect()) == [(0, "ZeroDivisionError"), (0, "ZeroDivisionError"), (2, "KeyError"), (4, "TypeError")]


PB = '<frameset><predicate lemma="leave"><roleset id="leave.01" name="go"><aliases><alias pos="v">leave</alias></aliases><roles><role n="0" f="PAG" descr="leaver"/><role n="1" f="PPT" descr="place"/></roles></roleset><roleset id="leave.02" name="give"/></predicate></frameset>'


def test_rolesets(spark, tmp_path):
    root = put(tmp_path, good__xml=PB, bad__xml='<frameset><predicate lemma="x"><roleset id="x.01" name="a"')
    rows = lexical.scan_rolesets(spark, root)
    assert {(r.path, r.lemma, r.roleset_id, r.name) for r in rows.collect()} == {("good.xml", "leave", "leave.01", "go"), ("good.xml", "leave", "leave.02", "give")}
    assert [tuple(r) for r in lexical.roleset_arguments(rows).orderBy("ord").collect()] == [("leave.01", 0, "0", "PAG", "leaver"), ("leave.01", 1, "1", "PPT", "place")]
    ids, issues = lexical.scan_roleset_ids(spark, root)
    assert {tuple(r) for r in ids.collect()} == {("good.xml", "leave.01", "parser"), ("good.xml", "leave.02", "parser"), ("bad.xml", "x.01", "pattern")}
    assert [tuple(r) for r in issues.collect()] == [("bad.xml", "malformed_xml")]


def test_repaired_rolesets(spark, tmp_path):
    """As the reference's two repairs: a closing tag of another element, an attribute without quotes."""
    file = lambda inner: f'<frameset><predicate lemma="l"><roleset id="{{}}.01" name="n"><example name="e" src="s"><text>t</text>{inner}</example></roleset></predicate></frameset>'
    tag, quote, amp = file('<arg n="1">in</rel>').format("tag"), file("").replace('src="s"', "src=a b").format("quote"), file("").replace("<text>t", "<text>a & b").format("amp")
    texts = {"good__xml": file("").format("good"), "tag__xml": tag, "quote__xml": quote, "amp__xml": amp, "other__xml": amp, "twice__xml": amp, "none__xml": amp, "still__xml": amp, "fine__xml": file("").format("fine"), "cut__xml": PB[:60]}
    root = put(tmp_path, **texts)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    repairs = [("r1", "tag.xml", sha(tag), "in</rel>", "in</arg>"), ("r2", "quote.xml", sha(quote), "src=a b", 'src="a b"'), ("r3", "other.xml", sha("x"), "a & b", "a &amp; b"), ("r4", "none.xml", sha(amp), "no such", ""), ("r5", "still.xml", sha(amp), "<text>", "<text>&"), ("r6", "fine.xml", sha(texts["fine__xml"]), "l", "m"), ("r7", "lost.xml", "", "a", "b"), ("r8", "twice.xml", sha(amp), "a & b", "c"), ("r9", "twice.xml", sha(amp), "a & b", "c")]
    tables = lexical.project_rolesets(spark, root, "*.xml", spark.createDataFrame(repairs, lexical.REPAIRS))
    outcome = {r.path.removesuffix(".xml"): r.outcome for r in tables["files"].collect()}
    assert outcome == {"good": "parsed", "tag": "repaired", "quote": "repaired", "amp": "invalid_xml", "other": "wrong_file", "none": "fragment", "still": "still_invalid", "fine": "not_needed", "twice": "several_repairs", "cut": "invalid_xml"}
    assert {r.roleset_id for r in tables["rolesets"].collect()} == {"good.01", "tag.01", "quote.01", "fine.01"}
    fixed = {r.path: (r.original_sha256, r.repaired_sha256) for r in tables["files"].filter("outcome = 'repaired'").collect()}
    assert fixed["tag.xml"] == (sha(tag), sha(tag.replace("in</rel>", "in</arg>")))
    assert tables["issues"].count() == 7 and [r.repair_id for r in tables["unused"].collect()] == ["r7"]
    with pytest.raises(ValueError, match="amp.xml"):
        lexical.rolesets_or_fail(tables)
    clean = lexical.project_rolesets(spark, root, "good.xml")
    assert lexical.rolesets_or_fail(clean)["rolesets"].count() == 1


def test_frames(spark, tmp_path):
    (tmp_path / "f").mkdir()
    root = put(tmp_path / "f", a__xml='<frame ID="1" name="Leave"><definition>d</definition><FE ID="10" name="Theme" abbrev="T" coreType="Core"><definition>x</definition></FE><FE ID="11" name="Goal" coreType="Core"/><lexUnit ID="5" name="leave.v" POS="V" status="Problem"/></frame>')
    got = lexical.scan_frames(spark, root)
    assert tuple(got["frames"].first()) == (1, "Leave", "d") and [(r.fe_id, r.ord) for r in got["fes"].orderBy("ord").collect()] == [(10, 0), (11, 1)] and got["lus"].first().status == "Problem"
    rel = put(tmp_path, r__xml='<frameRelations><frameRelationType ID="1" name="Inheritance"><frameRelation ID="7" subID="1" supID="2" subFrameName="A" superFrameName="B"><FERelation ID="9" subID="10" supID="20" subFEName="x" superFEName="y"/></frameRelation></frameRelationType></frameRelations>')
    out = lexical.scan_frame_relations(spark, rel + "/r.xml")
    assert {(r.direction, r.sub_id, r.super_id, r.sub_name) for r in out["relations"].collect()} == {("outgoing", 1, 2, "A"), ("incoming", 2, 1, "B")}
    assert tuple(out["fe_relations"].first()) == (7, 9, 10, 20)
    put(tmp_path, i__xml='<frameIndex><frame ID="1" name="Leave"/></frameIndex>', l__xml='<luIndex><lu ID="5" name="leave.v" frameID="1" status="New"/></luIndex>')
    index = lexical.scan_indexes(spark, f"{tmp_path}/i.xml", f"{tmp_path}/l.xml")
    assert tuple(index["frames"].first()) == (1, "Leave") and tuple(index["lus"].first()) == (5, "leave.v", 1, "New")


KIF = '; a (comment\n(subclass Leaving Process)\n(documentation Leaving "a (string) ; here \\" and")\n\n(domain agent 2 AutonomousAgent)\n(=> (instance ?X Leaving)\n    (exists (?Y) (agent ?X ?Y)))\n(range SizeFn Number) (disjoint A B)\n(open'


def test_axioms(spark, tmp_path):
    root = put(tmp_path, m__kif=KIF)
    rows = lexical.scan_axioms(spark, root).orderBy("formula_index").collect()
    assert [(r.formula_index, r.start_line, r.head, len(r.parts)) for r in rows] == [(1, 2, "subclass", 2), (2, 3, "documentation", 2), (3, 5, "domain", 3), (4, 6, "=>", 2), (5, 8, "range", 2), (6, 8, "disjoint", 2)]
    assert rows[3].parts[0] == "(instance ?X Leaving)" and rows[0].formula_sha256 == hashlib.sha256(b"(subclass Leaving Process)").hexdigest()
    fam = lexical.axiom_families(lexical.scan_axioms(spark, root))
    assert tuple(fam["subclass"].first())[:2] == ("Leaving", "Process") and fam["disjoint"].count() == 2
    assert {(r.relation, r.position, r.is_range, r.type) for r in fam["constraint"].collect()} == {("agent", 2, False, "AutonomousAgent"), ("SizeFn", None, True, "Number")}
    symbols = {r.symbol for r in lexical.scan_symbols(files.whole_texts(spark, root)).collect()}
    assert {"Leaving", "Process", "agent", "SizeFn", "open"} <= symbols and not {"string", "comment", "X", "here"} & symbols


def test_files_of_many_keys(spark, sf_dir):
    """The files of the XML queries hold many keys each: a file for every few hundred is more work than what is in it."""
    for name, most in (("scan_frame_relations", 1), ("scan_indexes", 2)):
        assert 1 <= len(QUERIES[name](spark, sf_dir).inputFiles()) <= most, name
