"""Texts with page and line markers, and texts with ``#div`` markers, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

FOLIO = r"\d+[abx]+"
PAGE, LINE = rf"(?Us)^\[({FOLIO})\]$", rf"(?Us)^\[({FOLIO})\.(\d+)\](.*)$"
#: Whether a text has a page, or a division, at all.
ANY_PAGE, ANY_DIVISION = rf"(?Um)^\s*\[{FOLIO}(?:\.\d+)?\]", r"(?U)#div\d+\s"
MILESTONE = r"\{(D\d+(?:-\d+)?)\}"
STRIP = r"(?U)^\s+|\s+$"


def marked_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, seq, page_seq, folio, is_page, line_num, content`` of ``doc_id, content``.

    A page marker, or a line marker of another folio, opens a page. Lines without a marker belong to the page
    that is open, with null ``line_num``; blank ones and those before the first page go. Page markers stay as
    rows, so that pages without lines are not lost.
    """
    rows = docs.select("doc_id", F.posexplode(F.split("content", "\n", -1)).alias("seq", "line"))
    page = F.regexp_extract(F.regexp_replace("line", STRIP, ""), PAGE, 1)
    rows = rows.withColumn("p", F.when(page != "", page)).withColumn("f", F.when(F.col("p").isNull() & F.col("line").rlike(LINE), F.regexp_extract("line", LINE, 1)))
    w = Window.partitionBy("doc_id").orderBy("seq")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    named = F.coalesce("p", "f")
    rows = rows.withColumn("folio", F.last(named, ignorenulls=True).over(upto)).withColumn("was", F.last(named, ignorenulls=True).over(before))
    opens = F.col("p").isNotNull() | (F.col("f").isNotNull() & ~F.col("f").eqNullSafe(F.col("was")))
    rows = rows.withColumn("page_seq", F.sum(opens.cast("int")).over(upto)).where("folio is not null")
    rows = rows.where("p is not null or f is not null or line rlike '(?U)\\\\S'")
    number = F.when(F.col("f").isNotNull(), F.regexp_extract("line", LINE, 2))
    content = F.when(F.col("f").isNotNull(), F.regexp_extract("line", LINE, 3)).otherwise(F.col("line"))
    return rows.select("doc_id", "seq", "page_seq", "folio", F.col("p").isNotNull().alias("is_page"), number.alias("line_num"), F.when(F.col("p").isNull(), content).alias("content"))


def milestones(lines: DataFrame) -> DataFrame:
    """``doc_id, seq, pos, id, folio, line`` of the milestones in marked lines, several to a line."""
    found = F.regexp_extract_all("content", F.lit(MILESTONE), F.lit(1))
    return lines.where("line_num is not null").select("doc_id", "seq", F.posexplode(found).alias("pos", "id"), "folio", F.col("line_num").alias("line"))


def pages(lines: DataFrame) -> DataFrame:
    """``doc_id, page_seq, folio, lines array<struct<line_num, content>>`` in order; pages without lines stay."""
    kept = F.collect_list(F.when(~F.col("is_page"), F.struct("seq", "line_num", "content")))
    rows = lines.groupBy("doc_id", "page_seq").agg(F.min_by("folio", "seq").alias("folio"), F.array_sort(kept).alias("x"))  # one page's lines
    return rows.select("doc_id", "page_seq", "folio", F.transform("x", lambda s: F.struct(s["line_num"].alias("line_num"), s["content"].alias("content"))).alias("lines"))


def split_divs(docs: DataFrame) -> DataFrame:
    """``doc_id, seq, line``: every ``#div`` at the start of a line of its own, what is before it trimmed at the right."""
    text = F.regexp_replace("content", r"(?m)^[^\S\n]+(?=#div)", "")
    text = F.regexp_replace(text, r"[^\S\n]*(?=#div)(?<!^|\n)", "\n")
    return docs.select("doc_id", F.posexplode(F.split(text, "\n", -1)).alias("seq", "line"))


def headed(docs: DataFrame) -> DataFrame:
    """Adds ``in_header`` to the lines: before the first line that starts with ``#``."""
    w = Window.partitionBy("doc_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return split_divs(docs).withColumn("in_header", F.max(F.col("line").startswith("#").cast("int")).over(w) == 0)


def metadata(docs: DataFrame) -> DataFrame:
    """``doc_id, meta map<string, string>`` of header lines ``key = value``; the last of a key wins."""
    rows = headed(docs).where("in_header and line like '%=%'")
    strip = lambda c: F.regexp_replace(c, STRIP, "")
    rows = rows.withColumn("k", strip(F.substring_index("line", "=", 1))).withColumn("v", strip(F.expr("substr(line, instr(line, '=') + 1)")))
    last = rows.groupBy("doc_id", "k").agg(F.max_by("v", "seq").alias("v"))
    return last.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("meta"))


def divisions(docs: DataFrame, mode: str = "intended") -> DataFrame:
    """``doc_id, seq, level, title, content`` of ``#divN title`` and the non-blank lines below it.

    Text before the first division goes. A malformed marker starts no division: ``intended`` ignores it;
    ``as_coded`` ends the open one there and repeats it, and all repetitions get the last content.
    """
    head = r"(?U)^#div(\d+)\s+(.*)"
    rows = headed(docs).where("not in_header")
    marker = F.col("line").startswith("#div")
    good = marker & F.col("line").rlike(head)
    w = Window.partitionBy("doc_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("div", F.sum(good.cast("int")).over(w)).withColumn("bad", F.sum((marker & ~good).cast("int")).over(w)).withColumn("marker", marker).where("div > 0")
    body = F.collect_list(F.when(~F.col("marker") & F.col("line").rlike(r"(?U)\S"), F.struct("seq", "line")))
    first = F.min_by("line", "seq")
    strip = lambda c: F.regexp_replace(c, STRIP, "")
    join = lambda x: strip(F.array_join(F.transform(F.array_sort(x), lambda s: s["line"]), "\n"))
    out = rows.groupBy("doc_id", "div").agg(first.alias("head"), body.alias("body"), (F.max("bad") - F.min("bad")).alias("bad"))  # one division's lines
    out = out.select("doc_id", F.col("div").cast("int").alias("seq"), F.regexp_extract("head", head, 1).cast("int").alias("level"), strip(F.regexp_extract("head", head, 2)).alias("title"), join(F.col("body")).alias("content"), "bad")
    if mode == "as_coded":
        return out.withColumn("rep", F.explode(F.sequence(F.lit(0), F.col("bad").cast("int")))).drop("bad")
    return out.drop("bad")


def paragraphs(content):
    """Paragraphs between blank lines, each with its lines joined by a space."""
    parts = F.split(content, r"(?U)\n[^\S\n]*\n\s*", -1)
    return F.filter(F.transform(parts, lambda p: F.regexp_replace(F.regexp_replace(p, STRIP, ""), r"(?U)\s*\n\s*", " ")), lambda p: p != "")
