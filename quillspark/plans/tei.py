"""Whole-document pipelines: marked texts, divided texts, runs of word-processor files, size-marked texts."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.functions import markup, normalize
from quillspark.operators import segments, structure
from quillspark.session import ship
from quillspark.sources import markers, rtf


def marked_text_tei(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From ``ie_id, ve_id, ut_id, vol_num, path, content, sha256``: TEI per file, and milestones with end ids.

    Lines are normalised, annotated and trimmed; empty ones go and pages without lines stay.
    """
    docs = files.select(F.col("ut_id").alias("doc_id"), "content")
    lines = markers.marked_lines(docs)
    texts = lines.withColumn("tei", markup.line_markup(F.coalesce("content", F.lit(""))))
    row = F.when(F.col("is_page"), "").otherwise(F.when(F.col("tei") != "", F.concat(F.lit("\n<lb/>"), F.col("tei"))).otherwise(""))
    page = texts.withColumn("row", row).groupBy("doc_id", "page_seq").agg(F.min_by("folio", "seq").alias("folio"), F.array_sort(F.collect_list(F.struct("seq", "row"))).alias("rows"))
    page = page.withColumn("xml", F.concat(F.lit('<pb n="'), F.col("folio"), F.lit('"/>'), F.array_join(F.transform("rows", lambda r: r["row"]), "")))
    body = page.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_seq", "xml"))), lambda p: p["xml"]), "\n").alias("body"))
    out = files.join(body, files["ut_id"] == body["doc_id"], "left")
    tei = markup.tei_document(F.col("ie_id"), F.col("ve_id"), F.col("ut_id"), F.col("path"), F.col("sha256"), F.coalesce("body", F.lit("")))
    marks = markers.milestones(lines).join(files.select(F.col("ut_id").alias("doc_id"), "ie_id", "ve_id", "vol_num"), "doc_id")
    marks = structure.milestone_ends(marks, ["ie_id", "vol_num"], ["seq", "pos"])
    return out.select("ie_id", "ve_id", "ut_id", F.concat(F.lit("archive/"), F.col("ve_id"), F.lit("/"), F.col("ut_id"), F.lit(".xml")).alias("path"), tei.alias("content")), marks


def divided_text_tei(files: DataFrame, mode: str = "intended") -> tuple[DataFrame, DataFrame]:
    """From files as above: TEI with nested divisions, and outline rows with start and end ids.

    Level 1 lies in the body, level 2 in the last level 1, deeper ones in the last level 2 (else 1); a
    division without a place goes but keeps its number.
    """
    docs = files.select(F.col("ut_id").alias("doc_id"), "content")
    divs = markers.divisions(docs, mode).withColumn("title", normalize.normalize_text(F.col("title"))).withColumn("body", normalize.normalize_text(F.col("content")))
    order = ["seq", "rep"] if mode == "as_coded" else ["seq"]
    placed = structure.nest(divs, ["doc_id"], order).where("kept")
    w = Window.partitionBy("doc_id").orderBy("div_no")
    paras = F.array_join(F.transform(markers.paragraphs(F.col("body")), lambda p: F.concat(F.lit("<p>"), markup.escape_xml(p), F.lit("</p>"))), "\n")
    # a division closes itself and those around it that the next one is not in
    holder = placed.select("doc_id", F.col("div_no").alias("parent"), F.col("level").alias("parent_level"))
    placed = placed.join(holder, ["doc_id", "parent"], "left")
    nested = F.when(F.col("level") == 1, 1).when(F.col("parent_level") == 2, 3).otherwise(2)
    placed = placed.withColumn("nested", nested)
    following = F.coalesce(F.lead("nested").over(w), F.lit(1))
    closes = F.repeat(F.lit("</div>\n"), F.greatest(F.col("nested") - following + 1, F.lit(0)))
    xml = F.concat(F.lit('<milestone xml:id="'), F.format_string("div%d_%04d", "level", "div_no"), F.lit('" unit="section"/>\n<div>\n<head>'), markup.escape_xml(F.col("title")), F.lit("</head>\n"), F.when(paras != "", F.concat(paras, F.lit("\n"))).otherwise(""), closes)
    body = placed.withColumn("xml", xml).groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("div_no", "xml"))), lambda d: d["xml"]), "").alias("body"))
    out = files.join(body, files["ut_id"] == body["doc_id"], "left")
    tei = markup.tei_document(F.col("ie_id"), F.col("ve_id"), F.col("ut_id"), F.col("path"), F.col("sha256"), F.coalesce("body", F.lit("")), layout="divisions")
    ends = structure.div_ends(divs, ["doc_id"], order).join(files.select(F.col("ut_id").alias("doc_id"), "ie_id", "ve_id", "vol_num"), "doc_id")
    return out.select("ie_id", "ve_id", "ut_id", F.concat(F.lit("archive/"), F.col("ve_id"), F.lit("/"), F.col("ut_id"), F.lit(".xml")).alias("path"), tei.alias("content")), ends


def runs_tei_body(runs: DataFrame, per_run: bool = True, keep_blank: bool = False) -> DataFrame:
    """``doc_id, body`` of runs: headers, footers and pictures go, sizes become ``<hi>``, newlines ``<lb/>``.

    ``per_run`` normalises each run (else the whole body, which keeps signs at a run's start); ``keep_blank``
    keeps runs of white space. Breaks are newlines in the most frequent size.
    """
    rows = runs.where("type is null or type not in ('header', 'footer', 'pict')")
    text = F.when(F.col("type").like("%_break"), "\n").otherwise(F.coalesce("text", F.lit("")))
    rows = rows.withColumn("text", text)
    if per_run:
        rows = rows.withColumn("text", F.when(F.col("text") == "\n", "\n").otherwise(normalize.normalize_text(markup.clean_fallback_characters(F.col("text")))))
    if not keep_blank:
        rows = rows.where("text = '\n' or text rlike '(?U)\\\\S'")
    sized = rows.where("font is not null").groupBy("doc_id", F.col("font.size").alias("fs")).agg(F.sum(markup.count_tibetan(F.col("text"))).cast("long").alias("cnt")).where("cnt > 0")
    classes = segments.classify(sized, "doc_id", "D").select("doc_id", "fs", "class")
    rows = rows.withColumn("fs", F.col("font.size")).join(classes, ["doc_id", "fs"], "left").withColumn("class", F.coalesce("class", F.lit("regular")))
    rows = structure.islands(rows, ["doc_id"], ["seq"], structure.changed("class", ["doc_id"], ["seq"]))
    part = rows.groupBy("doc_id", "island").agg(F.first("class").alias("class"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), "").alias("text"))
    inner = markup.escape_xml(F.col("text"))
    part = part.withColumn("xml", F.when(F.col("class") == "regular", inner).otherwise(F.concat(F.lit('<hi rend="'), F.when(F.col("class") == "large", "head").otherwise("small"), F.lit('">'), inner, F.lit("</hi>"))))
    body = part.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("island", "xml"))), lambda x: x["xml"]), "").alias("body"))
    if not per_run:
        body = body.withColumn("body", normalize.normalize_text(F.col("body")))
    rules = [(r'<hi rend="[^"]+">\s*</hi>', ""), ("\n", "\n<lb/>"), (r"\n+(?=\n<lb/>)", ""), (r" *<lb/> *", "<lb/>"), (r"\n<lb/>(?=\s*\n<lb/>)", ""), (r"\n<lb/></hi>", "</hi>\n<lb/>"), (r'(<hi rend="[^"]+">)\n<lb/>', "\n<lb/>$1")]
    return body.select("doc_id", markup.rewrite(F.col("body"), rules).alias("body"))


def rtf_tei(files: DataFrame, dialect: str = "v2", legacy_table: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """From ``ie_id, ve_id, ut_id, path, content (binary), sha256``: TEI, and issues ``doc_id, code, detail``."""
    parsed = rtf.runs(files.select(F.col("ut_id").alias("path"), "content"), dialect)
    issues = files.where("content is null").select(F.col("ut_id").alias("doc_id"), F.lit("NO_CONTENT").alias("code"), F.col("path").alias("detail"))
    if legacy_table is not None:
        parsed = rtf.decode_runs(parsed, legacy_table)
        issues = issues.unionByName(parsed.where("not decoded").select("doc_id", F.lit("UNKNOWN_FONT").alias("code"), F.col("font.name").alias("detail")).distinct())
    body = runs_tei_body(parsed, per_run=dialect != "v3", keep_blank=dialect == "v3")
    out = files.join(body, files["ut_id"] == body["doc_id"], "left")
    tei = markup.tei_document(F.col("ie_id"), F.col("ve_id"), F.col("ut_id"), F.col("path"), F.col("sha256"), F.coalesce("body", F.lit("")))
    return out.select("ie_id", "ve_id", "ut_id", F.concat(F.lit("archive/"), F.col("ve_id"), F.lit("/"), F.col("ut_id"), F.lit(".xml")).alias("path"), tei.alias("content")), issues


def _simplify_and_normalize(ra_rule: str):
    """Both steps that need Python, in one pass over the texts."""

    def work(batches):
        for batch in batches:
            k = batch.schema.get_field_index("text")
            made = [normalize.normalized(None if t is None else segments.simplified(t), ra_rule=ra_rule) for t in batch.column(k).to_pylist()]
            yield batch.set_column(k, batch.schema.field(k), pa.array(made, batch.schema.field(k).type))

    return work


def sized_text_tei(docs: DataFrame, registry: DataFrame, blanks: DataFrame | None = None, ra_rule: str = "A", mode: str = "intended") -> tuple[DataFrame, DataFrame]:
    """From ``doc_id, vol, ord, text`` (size tags and ZZZZ): ``doc_id, vol, page_start, body``, and issues.

    Simplify sizes, normalise, look the size set up in ``registry(profile, sizes, ord, classes map)``, mark up,
    drop trailing blank pages (``blanks(doc_id, blanks)``, default 0), number pages through the volume, to TEI.
    Texts without a profile are skipped with an issue; texts without sizes pass. ``as_coded`` leaves signs of XML
    as they are, which ``intended`` escapes.
    """
    ship(docs.sparkSession)
    rows = docs.mapInArrow(_simplify_and_normalize(ra_rule), docs.schema)
    rows = rows.withColumn("sizes", segments.size_set(F.col("text")))
    rows = segments.match_profiles(rows, registry).join(F.broadcast(registry.select("profile", "classes")), "profile", "left")  # as there
    lost = (F.size("sizes") > 0) & F.col("profile").isNull()
    rows = rows.withColumn("lost", lost).withColumn("text", segments.apply_size_markup(F.col("text"), F.coalesce("classes", F.create_map().cast("map<int, string>"))))
    if blanks is not None:
        rows = rows.join(blanks.select("doc_id", "blanks"), "doc_id", "left")
    n = F.coalesce("blanks", F.lit(0)) if blanks is not None else F.lit(0)
    text, bad = markup.trim_trailing_pages(F.col("text"), n)
    rows = rows.withColumn("bad", bad).withColumn("text", text)
    no_profile = F.array(F.struct(F.lit("NO_PROFILE").alias("code"), segments.profile_key(F.col("sizes")).alias("detail")))
    found = F.when(F.col("lost"), no_profile).otherwise(F.transform("bad", lambda x: F.struct(F.lit("TRAILING_PAGES").alias("code"), x.alias("detail"))))
    issues = rows.select("doc_id", F.inline(found))
    rows = rows.where("not lost")
    if mode == "intended":
        rows = rows.withColumn("text", markup.escape_outside_sizes(F.col("text")))
    pages = F.size(F.split(markup.strip_leading_break(F.col("text")), "ZZZZ", -1))
    rows = rows.withColumn("pages", pages.cast("long"))
    rows = structure.running_start(rows, ["vol"], ["ord"], "pages", F.when(F.col("vol") == 1, 6).otherwise(4), mode)
    return rows.select("doc_id", "vol", "page_start", markup.markup_to_tei(F.col("text"), F.col("page_start").cast("int"), mode=mode).alias("body")), issues


def source_issues(files: DataFrame, kind: str) -> DataFrame:
    """Issues ``doc_id, code, detail`` of marked (``pages``) or divided (``divisions``) texts ``ut_id, path, content``:
    content that can't be read, and texts without a page or a division.
    """
    missing = F.col("content").isNull()
    pattern = markers.ANY_PAGE if kind == "pages" else markers.ANY_DIVISION
    code = F.when(missing, "NO_CONTENT").when(~F.col("content").rlike(pattern), "NO_PAGES" if kind == "pages" else "NO_DIVISIONS")
    return files.select(F.col("ut_id").alias("doc_id"), code.alias("code"), F.col("path").alias("detail")).where("code is not null")


def sized_files_tei(files: DataFrame, registry: DataFrame, titles: DataFrame, boundaries: DataFrame, blanks: DataFrame | None = None, **how) -> tuple[DataFrame, DataFrame]:
    """From ``ie_id, ve_id, ut_id, vol, ord, path, sha256, text`` (size tags and ZZZZ): TEI files, and all issues.

    The chain of ``sized_text_tei``, then milestones on the pages of ``boundaries(vol, page)``, then the title of
    ``titles(vol, page, title, row_idx)`` at a text's first page.
    """
    bodies, issues = sized_text_tei(files.select(F.col("ut_id").alias("doc_id"), "vol", "ord", "text"), registry, blanks, **how)
    text, unresolved = structure.milestones_in_text(bodies.select("doc_id", "vol", F.col("body").alias("text")), boundaries)
    named, untitled = structure.titled(bodies.select(F.col("doc_id").alias("ut_id"), "vol", F.col("page_start").cast("int").alias("page")), titles)
    rows = files.drop("text", "vol").join(named.select("ut_id", "title"), "ut_id").join(text.select(F.col("doc_id").alias("ut_id"), F.col("text").alias("body")), "ut_id")
    tei = markup.tei_document(F.col("ie_id"), F.col("ve_id"), F.col("ut_id"), F.col("path"), F.col("sha256"), F.col("body"), title=F.col("title"))
    found = issues.unionByName(untitled).unionByName(unresolved.select("doc_id", F.lit("NO_PLACE_FOR_MILESTONE").alias("code"), F.col("page").cast("string").alias("detail")))
    return rows.select("ie_id", "ve_id", "ut_id", F.concat(F.lit("archive/"), F.col("ve_id"), F.lit("/"), F.col("ut_id"), F.lit(".xml")).alias("path"), tei.alias("content")), found


def job_totals(results: DataFrame) -> DataFrame:
    """``ie_id, success, failed, first_errors`` of ``ie_id, doc_id, ok, error``."""
    w = Window.partitionBy("ie_id", "ok").orderBy("doc_id")
    rows = results.withColumn("_k", F.row_number().over(w))
    first = F.array_sort(F.collect_list(F.when(~F.col("ok") & (F.col("_k") <= 3), F.struct("doc_id", "error"))))
    return rows.groupBy("ie_id").agg(F.count_if(F.col("ok")).alias("success"), F.count_if(~F.col("ok")).alias("failed"), F.transform(first, lambda x: x["error"]).alias("first_errors"))
