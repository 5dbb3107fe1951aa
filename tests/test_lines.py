"""Files read in ranges: a range of few bytes, so that each file has many."""

import random

import pytest
from pyspark.sql import functions as F

from crosslink.sources import files, lexical, lines


@pytest.fixture
def ranged(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    for name, value in zip(names, ("40", "1", "50")):
        spark.conf.set(name, value)
    yield spark
    for name in names:
        spark.conf.unset(name)


def put(root, **texts):
    root.mkdir(exist_ok=True)
    for name, text in texts.items():
        (root / name.replace("__", ".")).write_bytes(text.encode())
    return str(root)


@pytest.mark.parametrize("few", [0, lines.FEW_RANGES])
def test_numbers(ranged, tmp_path, monkeypatch, few):
    monkeypatch.setattr(lines, "FEW_RANGES", few)
    rnd = random.Random(1)
    texts = {f"f{i}__txt": rnd.choice(["", "\n"]).join(["", "\n".join("é" * rnd.choice([0, 1, 3, 30, 100]) + str(j) for j in range(n)), ""]) for i, n in enumerate((1, 2, 40, 400))}
    texts |= {"empty__txt": "", "crlf__txt": "a\r\nb\r\n\r\nc", "bom__txt": "﻿x\ny"}
    root = put(tmp_path / "n", **texts)
    got = {(r.path, r.line): r.text for r in lines.numbered_lines(ranged, root, "*.txt").collect()}
    want = {}
    for name, text in texts.items():
        parts = text.removeprefix("﻿").split("\n")
        want |= {(name.replace("__", "."), i): t.removesuffix("\r") for i, t in enumerate(parts[:-1] if parts[-1] == "" else parts)}
    assert got == want
    blocks = lines.block_table(lines.ranged_lines(ranged, root, "*.txt"))
    assert blocks.groupBy("path").count().agg(F.max("count")).first()[0] > 20
    kept = {(r.path, r.line): r.text for r in lines.numbered_lines(ranged, root, "f3*", lambda x: F.length(x) > 10).collect()}
    assert [t for _, t in sorted(kept.items())] == [t for k, t in sorted(want.items()) if k[0] == "f3.txt" and len(t) > 10] and min(kept)[1] == 0


def test_each_file_has_its_own_header(ranged, tmp_path):
    """The same channels in another order, other columns between, quoted names and cells."""
    body = lambda order: "".join(",".join(str({"t": i, "L1": i + 0.5, "L2": 10 * i, "note": '"a,""b"""'}[c]) for c in order) + "\n" for i in range(50))
    root = put(tmp_path / "c", a__csv="t,L1,L2\n" + body(["t", "L1", "L2"]), b__csv='L2,"note",L1\r\n' + body(["L2", "note", "L1"]).replace("\n", "\r\n"), c__csv="﻿L1, L2 \n\n" + body(["L1", "L2"]))
    rows = files.scan_channels(ranged, root, r"L([0-9]+)", range(1, 3)).collect()
    assert {(r.path, r.line): r.total for r in rows} == {(p, i): i + 0.5 + 10 * i for p in ("a.csv", "b.csv", "c.csv") for i in range(50)}
    second = files.scan_channels(ranged, root, r"L([0-9]+)", range(1, 3), drop=2, reverse=True).collect()
    assert {(r.path, r.line): r.total for r in second} == {(p, i): i + 0.5 for p in ("a.csv", "b.csv", "c.csv") for i in range(50)}


def test_wrong_channels_and_cells(spark, tmp_path):
    root = put(tmp_path / "w", a__csv="L1,L2\n1,2\n1\n1,x\n1,inf\n1,nan\n1e308,1e308\n")
    assert [r.total for r in files.scan_channels(spark, root, r"L([0-9]+)", range(1, 3)).orderBy("line").collect()] == [3.0, None, None, None, None, float("inf")]
    put(tmp_path / "w", b__csv="L1,L3\n1,2\n")
    with pytest.raises(ValueError, match=r"b.csv has the channels \[1, 3\]"):
        files.scan_channels(spark, root, r"L([0-9]+)", range(1, 3))
    with pytest.raises(ValueError, match="no lines"):
        files.scan_channels(spark, put(tmp_path / "none", x__txt=""), r"L([0-9]+)", range(1, 3))


def axiom_text(rnd, n):
    pieces = ["(a b)", "(a (b c) d)\n", '(a "x)\n(y" b) ', "; c ( \" comment\n", "(a\n  (b ; (\n c))\n", '(s "q\\" ( \\\\") (t "\n\n(((")\n', " ", "\n\n", ")", '(long ' + "(w x)\n " * 20 + ")", "(e)", "()"]
    return "".join(rnd.choice(pieces) for _ in range(n))


def test_formulas_of_any_cut(ranged, tmp_path):
    rnd = random.Random(2)
    texts = {f"m{i}__kif": axiom_text(rnd, n) for i, n in enumerate((0, 1, 5, 60, 200, 200))}
    texts |= {"open__kif": "(a b)\n(c (d\n" + "e\n" * 50, "quote__kif": "(a b) (c \"d)\n" + "(e)\n" * 50, "cr__kif": "(a\r\n b)\r\n" * 30}
    root = put(tmp_path / "k", **texts)
    got = {(r.path, r.formula_index): (r.start_line, r.formula) for r in lines.formulas(ranged, root).collect()}
    want = {(name.replace("__", "."), n): (line, text) for name, whole in texts.items() for n, line, _, _, text in lexical.split_formulas(whole)}
    assert got == want and len(want) > 300
    rows = {(r.module, r.formula_index): (r.head, r.parts) for r in lexical.scan_axioms(ranged, root).collect()}
    assert rows == {(name.replace("__", "."), n): (head, parts) for name, whole in texts.items() for n, _, head, parts, _ in lexical.split_formulas(whole)}


def test_passages_follow_each_other():
    """Two passages one after another are the passage of both."""
    rnd = random.Random(3)
    for _ in range(200):
        parts = [axiom_text(rnd, rnd.randint(0, 6)).split("\n") for _ in range(2)]
        one, two, both = lines.Passage(), lines.Passage(), lines.Passage()
        for p, x in zip(parts, (one, two)):
            for line in p:
                x.add(line)
                both.add(line)
        for start in (0, 1):
            for depth in range(4):
                middle, i = max(depth + one.rise[start], one.floor[start]), int(one.quoted[start])
                assert max(middle + two.rise[i], two.floor[i]) == max(depth + both.rise[start], both.floor[start]) and two.quoted[i] == both.quoted[start]
