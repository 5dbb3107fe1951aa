"""Lexical sources: roleset and frame XML, axiom files."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crosslink.functions.texts import occurrences, repaired
from crosslink.scratch import written
from crosslink.sources.files import whole_texts
from crosslink.sources.lines import formulas, fragments_of, relative

_LINK = "struct<_resource:string,_version:string,_class:string,_VALUE:string>"
ROLESETS = f"""array<struct<_id:string,_name:string,
  aliases:struct<alias:array<struct<_pos:string,_VALUE:string>>>,
  roles:struct<role:array<struct<_n:string,_f:string,_descr:string,rolelinks:struct<rolelink:array<{_LINK}>>>>>,
  lexlinks:struct<lexlink:array<struct<_resource:string,_version:string,_class:string,_confidence:string>>>,
  example:array<struct<_name:string,_src:string,text:string>>>>"""
REPAIRS = "repair_id string, relative_path string, source_file_sha256 string, old_fragment string, replacement_fragment string"


def project_rolesets(spark: SparkSession, root: str, pattern: str = "*.xml", repairs: DataFrame | None = None) -> dict[str, DataFrame]:
    """Roleset files, repaired where a repair is declared for them, then parsed; all tables come from one read.

    repairs: repair_id, relative_path, source_file_sha256, old_fragment, replacement_fragment. rolesets: path, lemma, roleset_id,
    name, aliases, arguments, links, examples. files: a row for each file with path, outcome, repair_id, original_sha256,
    repaired_sha256; outcome is parsed, repaired, invalid_xml, or why its repair can't be: several_repairs, wrong_file (another
    SHA-256), not_needed (the file parses as it is), fragment (it doesn't stand exactly once), still_invalid. issues: path, issue of
    all that are neither parsed nor repaired; unused: repairs (repair_id) of no file. A file with a repair that isn't needed still
    gives its rolesets; other files with an issue give none. Files are documents of one root and are read whole.
    """
    repairs = spark.createDataFrame([], REPAIRS) if repairs is None else repairs
    declared = repairs.groupBy(F.col("relative_path").alias("path")).agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("repair_id", "source_file_sha256", "old_fragment", "replacement_fragment")])
    parse = lambda text: F.from_xml(text, f"predicate array<struct<_lemma:string,roleset:{ROLESETS}>>, __bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})
    fine = lambda c: F.col(c).isNotNull() & F.col(f"{c}.__bad").isNull()
    texts = whole_texts(spark, root, pattern).join(declared, "path", "left").withColumns({"first": parse(F.col("text")), "sha": F.sha2("text", 256)})
    once = F.coalesce(occurrences(F.col("text"), F.col("old_fragment")) == 1, F.lit(False))
    why = F.when(F.col("n") > 1, "several_repairs").when(F.col("sha") != F.col("source_file_sha256"), "wrong_file").when(fine("first"), "not_needed").when(~once, "fragment")
    texts = texts.withColumn("why", F.when(F.col("n").isNotNull(), why)).withColumn("fixed", F.when(F.col("n").isNotNull() & F.col("why").isNull(), repaired(F.col("text"), F.col("old_fragment"), F.col("replacement_fragment"))))
    texts = texts.withColumn("second", F.when(F.col("fixed").isNotNull(), parse(F.col("fixed"))))
    outcome = F.coalesce("why", F.when(F.col("fixed").isNotNull(), F.when(fine("second"), "repaired").otherwise("still_invalid")), F.when(fine("first"), "parsed").otherwise("invalid_xml"))
    kept = F.when(fine("second"), F.col("second.predicate")).when(F.col("fixed").isNull() & fine("first"), F.col("first.predicate"))
    sha = F.when(F.col("fixed").isNotNull(), F.sha2("fixed", 256))
    found = written(texts.select("path", outcome.alias("outcome"), "repair_id", F.col("sha").alias("original_sha256"), sha.alias("repaired_sha256"), kept.alias("predicates")), "rolesets")
    rows = found.select("path", F.explode("predicates").alias("p")).select("path", F.col("p._lemma").alias("lemma"), F.explode("p.roleset").alias("r"))
    role = lambda x: F.struct(x["_n"].alias("number"), x["_f"].alias("function_tag"), x["_descr"].alias("description"), x["rolelinks"]["rolelink"].alias("role_links"))
    rolesets = rows.select("path", "lemma", F.col("r._id").alias("roleset_id"), F.col("r._name").alias("name"), F.col("r.aliases.alias").alias("aliases"), F.transform("r.roles.role", role).alias("arguments"), F.col("r.lexlinks.lexlink").alias("links"), F.col("r.example").alias("examples"))
    files = found.drop("predicates")
    unused = repairs.join(files.select(F.col("path").alias("relative_path")), "relative_path", "left_anti").select("repair_id")
    return {"rolesets": rolesets, "files": files, "issues": files.filter("outcome not in ('parsed', 'repaired')").select("path", F.col("outcome").alias("issue")), "unused": unused}


def rolesets_or_fail(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables of ``project_rolesets``, if every file is parsed or repaired and every repair has its file; else raises with the first issues."""
    bad = [tuple(r) for r in tables["issues"].orderBy("path").limit(5).collect()] + [(r.repair_id, "unused_repair") for r in tables["unused"].limit(5).collect()]
    if bad:
        raise ValueError(f"roleset files with issues: {bad}")
    return tables


def scan_rolesets(spark: SparkSession, root: str, pattern: str = "*.xml") -> DataFrame:
    """path, lemma, roleset_id, name, aliases, arguments, links, examples; one row for each roleset. ``project_rolesets`` also has the files that don't parse."""
    return project_rolesets(spark, root, pattern)["rolesets"]


def roleset_arguments(rolesets: DataFrame) -> DataFrame:
    """id, ord, number, function_tag, description."""
    return rolesets.select(F.col("roleset_id").alias("id"), F.posexplode("arguments").alias("ord", "a")).select("id", "ord", "a.number", "a.function_tag", "a.description")


def scan_roleset_ids(spark: SparkSession, root: str, pattern: str = "*.xml") -> tuple[DataFrame, DataFrame]:
    """(path, roleset_id, found_by) and (path, issue). Malformed files give ids by pattern and an issue."""
    texts = whole_texts(spark, root, pattern)
    parsed = texts.withColumn("x", F.from_xml("text", "predicate array<struct<roleset:array<struct<_id:string>>>>, __bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}))
    marked = parsed.withColumn("bad", F.col("x").isNull() | F.col("x.__bad").isNotNull())
    good = marked.filter("not bad").select("path", F.explode(F.flatten(F.transform("x.predicate", lambda p: F.transform(p["roleset"], lambda r: r["_id"])))).alias("roleset_id"), F.lit("parser").alias("found_by"))
    by_pattern = marked.filter("bad").select("path", F.explode(F.regexp_extract_all("text", F.lit(r'<roleset\b[^>]*?\bid="([^"]+)"'), F.lit(1))).alias("roleset_id"), F.lit("pattern").alias("found_by"))
    ids = good.unionByName(by_pattern).filter("roleset_id is not null").distinct()
    return ids, marked.filter("bad").select("path", F.lit("malformed_xml").alias("issue"))


FRAME = """_ID int, _name string, definition string, semType array<struct<_ID:int,_name:string>>,
  FE array<struct<_ID:int,_name:string,_abbrev:string,_coreType:string,definition:string,semType:array<struct<_ID:int,_name:string>>>>,
  lexUnit array<struct<_ID:int,_name:string,_POS:string,_status:string,semType:array<struct<_ID:int,_name:string>>>>, __bad string"""
#: The core types of a frame element.
CORE_TYPES = ["Core", "Core-Unexpressed", "Peripheral", "Extra-Thematic"]


def scan_frames(spark: SparkSession, root: str, pattern: str = "*.xml") -> dict[str, DataFrame]:
    """frames, fes (in document order), lus and sem_types (owner kind and id, type id and name) of frame files; issues: path, issue.

    A malformed file, a frame without id or name and an element of unknown core type are issues; ``frames_or_fail`` raises on them.
    """
    df = spark.read.format("xml").option("rowTag", "frame").option("pathGlobFilter", pattern).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "__bad").schema(FRAME).load(root)
    df = df.select("*", relative(F.col("_metadata.file_path"), root).alias("path"))
    key = F.col("_ID").alias("frame_id")
    fine = df.filter("__bad is null and _ID is not null and _name is not null")
    elements = fine.select("path", key, F.posexplode("FE").alias("ord", "e"))
    fes = elements.select("frame_id", F.col("e._ID").alias("fe_id"), F.col("e._name").alias("name"), F.col("e._abbrev").alias("abbrev"), F.col("e._coreType").alias("core_type"), F.col("e.definition").alias("definition"), "ord")
    units = fine.select(key, F.explode("lexUnit").alias("u"))
    lus = units.select("frame_id", F.col("u._ID").alias("lu_id"), F.col("u._name").alias("name"), F.col("u._POS").alias("pos"), F.col("u._status").alias("status"))
    typed = lambda rows, kind, owner, types: rows.select(F.lit(kind).alias("kind"), owner.alias("owner_id"), F.explode(types).alias("s")).select("kind", "owner_id", F.col("s._ID").alias("type_id"), F.col("s._name").alias("type_name"))
    sem = typed(fine, "frame", F.col("_ID"), F.col("semType")).unionByName(typed(elements, "fe", F.col("e._ID"), F.col("e.semType"))).unionByName(typed(units, "lu", F.col("u._ID"), F.col("u.semType")))
    broken = df.filter("__bad is not null or _ID is null or _name is null").select("path", F.lit("malformed_frame").alias("issue"))
    odd = elements.filter(~F.coalesce(F.col("e._coreType").isin(*CORE_TYPES), F.lit(False))).select("path", F.lit("unknown_core_type").alias("issue"))
    return {"frames": fine.select(key, F.col("_name").alias("name"), "definition"), "fes": fes, "lus": lus, "sem_types": sem, "issues": broken.unionByName(odd)}


def frames_or_fail(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables of ``scan_frames``, if they have no issue."""
    if bad := frames["issues"].limit(5).collect():
        raise ValueError(f"frame files with issues: {[tuple(r) for r in bad]}")
    return frames


RELATIONS = """_ID int, _name string, frameRelation array<struct<_ID:int,_subID:int,_supID:int,_subFrameName:string,_superFrameName:string,
  FERelation:array<struct<_ID:int,_subID:int,_supID:int,_subFEName:string,_superFEName:string>>>>"""


def scan_frame_relations(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """relations with direction (outgoing, and incoming with the ends swapped) and fe_relations."""
    df = spark.read.format("xml").option("rowTag", "frameRelationType").schema(RELATIONS).load(path)
    rows = df.select(F.col("_ID").alias("type_id"), F.col("_name").alias("type_name"), F.explode("frameRelation").alias("r"))
    out = rows.select(F.col("r._ID").alias("relation_id"), "type_id", "type_name", F.col("r._subID").alias("sub_id"), F.col("r._supID").alias("super_id"), F.col("r._subFrameName").alias("sub_name"), F.col("r._superFrameName").alias("super_name"))
    back = out.select("relation_id", "type_id", "type_name", F.col("super_id").alias("sub_id"), F.col("sub_id").alias("super_id"), F.col("super_name").alias("sub_name"), F.col("sub_name").alias("super_name"))
    fe = rows.select(F.col("r._ID").alias("relation_id"), F.explode("r.FERelation").alias("e")).select("relation_id", F.col("e._ID").alias("fe_relation_id"), F.col("e._subID").alias("sub_fe_id"), F.col("e._supID").alias("super_fe_id"))
    return {"relations": out.withColumn("direction", F.lit("outgoing")).unionByName(back.withColumn("direction", F.lit("incoming"))), "fe_relations": fe}


def scan_indexes(spark: SparkSession, frame_index: str, lu_index: str) -> dict[str, DataFrame]:
    """frames (id, name) and lus (id, name, frame_id, status) of the index files."""
    frames = spark.read.format("xml").option("rowTag", "frame").schema("_ID int, _name string").load(frame_index)
    lus = spark.read.format("xml").option("rowTag", "lu").schema("_ID int, _name string, _frameID int, _status string").load(lu_index)
    return {"frames": frames.select(F.col("_ID").alias("id"), F.col("_name").alias("name")), "lus": lus.select(F.col("_ID").alias("id"), F.col("_name").alias("name"), F.col("_frameID").alias("frame_id"), F.col("_status").alias("status"))}


_TOKEN = re.compile(r';[^\n]*|"(?:\\.|[^"\\])*(?:"|$)|[()]|[^\s()";]+', re.S)


def split_formulas(text: str | None) -> Iterator[tuple[int, int, str, list[str], str]]:
    """The top-level formulas of an axiom text: number and line from 1, head, operands as text, the formula's text.

    Comments run from ``;`` to the end of the line, strings may hold brackets. Unbalanced ends give what is complete.
    """
    text = text or ""
    whole = ((a, b) for begins, ends, a, b in fragments_of(text, 0, False) if begins and ends)
    for n, (a, b) in enumerate(whole, 1):
        head, *parts = operands(text[a:b]) or [""]
        yield n, text.count("\n", 0, a) + 1, head, parts, text[a:b]


def operands(formula: str) -> list[str]:
    """Head and operands of one formula, nested ones as they stand in the text."""
    depth, part, out = 0, 0, []
    for m in _TOKEN.finditer(formula):
        if m[0] == "(":
            depth += 1
            part = m.start() if depth == 2 else part
        elif m[0] == ")":
            if depth == 2:
                out.append(formula[part : m.end()])
            depth -= 1
        elif depth == 1 and m[0][0] != ";":
            out.append(m[0])
    return out


def scan_axioms(spark: SparkSession, root: str, pattern: str = "*.kif") -> DataFrame:
    """module, formula_index, start_line, head, parts, formula_sha256 of all files that match; large files are read in ranges, see ``lines.formulas``."""
    found = formulas(spark, root, pattern)

    def parse(batches):
        import pandas as pd

        for batch in batches:
            lists = [operands(f) or [""] for f in batch["formula"]]
            yield pd.DataFrame({"module": batch["path"], "formula_index": batch["formula_index"], "start_line": batch["start_line"], "head": [x[0] for x in lists], "parts": [x[1:] for x in lists], "formula": batch["formula"]})

    df = found.mapInPandas(parse, "module string, formula_index long, start_line long, head string, parts array<string>, formula string")
    return df.select("module", "formula_index", "start_line", "head", "parts", F.sha2("formula", 256).alias("formula_sha256"))


def axiom_families(axioms: DataFrame) -> dict[str, DataFrame]:
    """instance, subclass, subrelation, constraint (kind, relation, position or range, type) and disjoint tables, with module and number."""
    ref = [F.col("module").alias("path"), F.col("formula_index").alias("idx")]
    two = lambda head, a, b: axioms.filter((F.col("head") == head) & (F.size("parts") == 2)).select(F.col("parts")[0].alias(a), F.col("parts")[1].alias(b), *ref)
    domain = axioms.filter("head in ('domain', 'domainSubclass') and size(parts) = 3").select(F.col("head").alias("kind"), F.col("parts")[0].alias("relation"), F.col("parts")[1].try_cast("int").alias("position"), F.col("parts")[2].alias("type"), F.lit(False).alias("is_range"), *ref)
    ranged = axioms.filter("head in ('range', 'rangeSubclass') and size(parts) = 2").select(F.col("head").alias("kind"), F.col("parts")[0].alias("relation"), F.lit(None).cast("int").alias("position"), F.col("parts")[1].alias("type"), F.lit(True).alias("is_range"), *ref)
    disjoint = axioms.filter("head in ('disjoint', 'partition', 'disjointDecomposition')").select(F.col("head").alias("kind"), F.explode("parts").alias("term"), *ref)
    return {"instance": two("instance", "instance", "class"), "subclass": two("subclass", "child", "parent"), "subrelation": two("subrelation", "child", "parent"), "constraint": domain.unionByName(ranged), "disjoint": disjoint}


def scan_symbols(texts: DataFrame) -> DataFrame:
    """symbol: distinct symbols of texts (column text) without comments and strings; variables (``?x``, ``@row``) and numbers aren't symbols."""
    plain = F.regexp_replace(F.regexp_replace("text", r'"(\\.|[^"\\])*"', " "), r";[^\n]*", " ")
    found = F.regexp_extract_all(plain, F.lit(r"(?<![A-Za-z0-9_?@-])[A-Za-z][A-Za-z0-9_-]*"), F.lit(0))
    return texts.select(F.explode(F.array_distinct(found)).alias("symbol")).distinct()
