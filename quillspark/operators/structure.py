"""Windows over ordered rows: pages, boundaries, neighbours, islands, outlines, coordinates, milestones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.functions.markup import strip_tags
from quillspark.functions.ordering import level_of, milestone_id
from quillspark.operators.joins import last_wins, ranked

PRECEDING = (Window.unboundedPreceding, -1)
#: Rows of one stretch of a table that is numbered over all rows.
STRETCH = 1 << 16


def numeric(text: Column | str) -> Column:
    return F.col(text).try_cast("int") if isinstance(text, str) else text.try_cast("int")


def boundary_pages(outline: DataFrame, order: str = "row_idx", by: list[str] | None = None) -> DataFrame:
    """Rows whose end volume and page are the next row's start, after rows with other than numbers are gone.

    Without ``by`` the next row may be any: rows are then numbered by range partitions and meet the next one in
    stretches of ``STRETCH`` numbers, to which the first row of the stretch after goes too; so no task gets them all,
    and no table of all rows is broadcast.
    """
    rows = outline.select("*", *[numeric(c).alias(f"_{c}") for c in ("vol_start", "vol_end", "img_start", "img_end")])
    rows = rows.where(reduce(lambda a, b: a & b, [F.col(f"_{c}").isNotNull() for c in ("vol_start", "vol_end", "img_start", "img_end")]))
    if not by:
        rows = ranked(rows.select(order, "_vol_start", "_vol_end", "_img_start", "_img_end"), [order], [], "_n")
        own = F.shiftright(F.col("_n"), STRETCH.bit_length() - 1)
        first = F.col("_n") % STRETCH == 0
        rows = rows.withColumn("_own", own).withColumn("_part", F.explode(F.when(first, F.array(own, own - 1)).otherwise(F.array(own))))
        rows = rows.withColumn("_next", F.lead(F.struct("_vol_start", "_img_start")).over(Window.partitionBy("_part").orderBy("_n"))).where("_own = _part")
        return rows.where("_vol_end = _next._vol_start and _img_end = _next._img_start").select(F.col("_vol_end").alias("vol"), F.col("_img_end").alias("page")).distinct()
    w = Window.partitionBy(*by).orderBy(order)
    hit = (F.col("_vol_end") == F.lead("_vol_start").over(w)) & (F.col("_img_end") == F.lead("_img_start").over(w))
    return rows.withColumn("_hit", hit).where("_hit").select(F.col("_vol_end").alias("vol"), F.col("_img_end").alias("page")).distinct()


def adjacent_ends(rows: DataFrame, by: list[str], order: list[str], start: str, end: str) -> DataFrame:
    """Rows whose next row in the group starts one after their end."""
    return rows.withColumn("next_start", F.lead(start).over(Window.partitionBy(*by).orderBy(*order))).where(F.col("next_start") == F.col(end) + 1)


def neighbours(rows: DataFrame, order: list[str]) -> DataFrame:
    """``prev_end`` and ``next_start``: pages of the rows just before and after on the same level and volume."""
    before = Window.partitionBy("level", "vol_start").orderBy(*order)
    after = Window.partitionBy("level", "vol_end").orderBy(*order)
    prev_end = F.when(F.lag("vol_end").over(before) == F.col("vol_start"), F.lag(numeric("img_end")).over(before))
    next_start = F.when(F.lead("vol_start").over(after) == F.col("vol_end"), F.lead(numeric("img_start")).over(after))
    return rows.withColumn("prev_end", prev_end).withColumn("next_start", next_start)


def running_start(rows: DataFrame, by: list[str], order: list[str], pages: str, seed: Column | int, mode: str = "intended") -> DataFrame:
    """``page_start``: seed plus the pages before a row of its group.

    ``as_coded``: placeholders of earlier pages are counted again, so that start' = 2 start - 1 + pages. A
    number beyond a long is null.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    earlier = F.coalesce(F.sum(pages).over(w.rowsBetween(*PRECEDING)), F.lit(0))
    if mode == "intended":
        return rows.withColumn("page_start", (seed + earlier).cast("long"))
    # start - 1 doubles with every row, so rows more than 62 back can only matter where the number has left a long
    k = F.row_number().over(w)
    past = F.collect_list(F.col(pages).cast("long")).over(w.rowsBetween(-62, -1))
    lost = F.coalesce(F.max(F.abs(F.col(pages))).over(w.rowsBetween(Window.unboundedPreceding, -63)), F.lit(0)) > 0
    first = F.when(F.col("_k") <= 63, seed.cast("long") - 1).otherwise(F.when(seed == 1, F.lit(0).cast("long")))
    rows = rows.withColumn("_k", k).withColumn("_past", past).withColumn("_lost", lost)
    return rows.withColumn("page_start", F.when(~F.col("_lost"), F.aggregate(F.col("_past"), first, lambda t, p: F.try_add(F.try_multiply(t, F.lit(2).cast("long")), p), lambda t: F.try_add(t, F.lit(1).cast("long"))))).drop("_k", "_past", "_lost")


def img_and_page_ranges(pdfs: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Running ranges of images (from 4, all files) and of pages (from 1, without contents files)."""
    n = F.col("total") - F.col("blanks")
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(*PRECEDING)
    content = F.when(F.col("is_contents"), 0).otherwise(n)
    rows = pdfs.withColumn("n", n).withColumn("img_start", 4 + F.coalesce(F.sum(n).over(w), F.lit(0)))
    rows = rows.withColumn("img_end", F.col("img_start") + F.col("n") - 1)
    rows = rows.withColumn("page_start", F.when(~F.col("is_contents"), 1 + F.coalesce(F.sum(content).over(w), F.lit(0))))
    return rows.withColumn("page_end", F.col("page_start") + F.col("n") - 1)


def image_ranges(toc: DataFrame, pdfs: DataFrame) -> DataFrame:
    """``folder, number, title, page, volnum, imgnum_start, imgnum_end`` of the rows of a table of contents.

    ``toc``: folder, row_idx, number, title, page (text). ``pdfs``: folder, ord, total, blanks, is_contents,
    volnum. Where a folder has as many content files as rows, they pair up by position; else pages become
    images and a row ends before the next one starts (-1 where a page is not a number). A row for the
    contents file comes first.
    """
    files = img_and_page_ranges(pdfs, ["folder"], ["ord"])
    w = Window.partitionBy("folder").orderBy("ord")
    files = files.withColumn("_k", F.row_number().over(w) - 1)
    facts = files.groupBy("folder").agg(F.count("*").alias("n_files"), (3 + F.sum("n")).alias("total_imgs"), F.min(F.when(~F.col("is_contents"), F.struct("ord", "img_start")))["img_start"].alias("first_img"), F.first("volnum").alias("volnum"))
    rows = toc.withColumn("_k", F.row_number().over(Window.partitionBy("folder").orderBy("row_idx")))
    counts = toc.groupBy("folder").agg(F.count("*").alias("n_rows"))
    rows = rows.join(facts, "folder").join(counts, "folder").withColumn("simple", F.col("n_files") - 1 == F.col("n_rows"))
    rows = rows.join(files.select("folder", "_k", F.col("img_start").alias("own_start"), F.col("img_end").alias("own_end")), ["folder", "_k"], "left")
    img = lambda p: F.coalesce(F.when(p >= 1, F.col("first_img") + p - 1), F.lit(-1))
    after = Window.partitionBy("folder").orderBy("row_idx")
    page, following, has_next = numeric("page"), F.lead(numeric("page")).over(after), F.lead("row_idx").over(after).isNotNull()
    start = F.when(F.col("simple"), F.col("own_start")).when(page.isNull(), -1).otherwise(img(page))
    end = F.when(F.col("simple"), F.col("own_end")).when(~has_next, F.col("total_imgs")).when(following.isNull(), -1).otherwise(img(following) - 1)
    body = rows.select("folder", F.col("_k").alias("pos"), F.col("number").cast("string").alias("number"), "title", F.col("page").cast("string").alias("page"), "volnum", start.cast("long").alias("imgnum_start"), end.cast("long").alias("imgnum_end"))
    head = files.where("_k = 0").select("folder", F.lit(0).alias("pos"), F.lit("0").alias("number"), F.lit("contents").alias("title"), F.lit("0").alias("page"), "volnum", F.col("img_start").cast("long").alias("imgnum_start"), F.col("img_end").cast("long").alias("imgnum_end"))
    return head.unionByName(body)


def div_ends(divs: DataFrame, by: list[str], order: list[str], deepest: int = 2) -> DataFrame:
    """``div_no`` over all levels, ``start_id`` and ``end_id`` (the next div at most as deep); deeper ones go last.

    The next div is the last one seen when rows are read backwards, so a group is passed once.
    """
    rows = divs.withColumn("div_no", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    back = Window.partitionBy(*by).orderBy(F.desc("div_no")).rowsBetween(Window.unboundedPreceding, -1)
    ref = lambda x: F.format_string("1#div%d_%04d", x["level"], x["div_no"])
    here = F.struct("div_no", "level")
    one, two = (F.last(F.when(held, here), ignorenulls=True).over(back) for held in (F.col("level") == 1, F.col("level") <= 2))
    end = F.when(F.col("level") == 1, one).otherwise(two)
    rows = rows.withColumn("start_id", F.format_string("1#div%d_%04d", "level", "div_no")).withColumn("end_id", F.when(end.isNull(), "").otherwise(ref(end)))
    return rows.where(F.col("level") <= deepest)


def milestone_ends(milestones: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``end_id``: the next milestone of the volume, empty for its last."""
    return milestones.withColumn("end_id", F.coalesce(F.lead("id").over(Window.partitionBy(*by).orderBy(*order)), F.lit("")))


def nest(divs: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``parent``: number of the div that holds a div (0: the body); divs with no place to go have ``kept`` false."""
    w = Window.partitionBy(*by).orderBy(*order)
    rows = divs.withColumn("div_no", F.row_number().over(w))
    upto = w.rowsBetween(*PRECEDING)
    one = F.last(F.when(F.col("level") == 1, F.col("div_no")), ignorenulls=True).over(upto)
    two = F.last(F.when(F.col("level") == 2, F.col("div_no")), ignorenulls=True).over(upto)
    parent = F.when(F.col("level") == 1, F.lit(0)).when(F.col("level") == 2, one).when(F.col("level") >= 3, F.when(two > one, two).otherwise(one))
    return rows.withColumn("parent", parent).withColumn("kept", parent.isNotNull())


def carry_forward(rows: DataFrame, by: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """The last non-null value up to a row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(w))


def islands(rows: DataFrame, by: list[str], order: list[str], starts: Column, name: str = "island") -> DataFrame:
    """Number of the run that a row belongs to; a run starts where ``starts`` is true, and at the first row."""
    w = Window.partitionBy(*by).orderBy(*order)
    first = F.row_number().over(w) == 1
    flagged = rows.withColumn("_start", (first | F.coalesce(starts, F.lit(False))).cast("int"))
    return flagged.withColumn(name, F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_start")


def changed(column: str, by: list[str], order: list[str]) -> Column:
    return ~F.col(column).eqNullSafe(F.lag(column).over(Window.partitionBy(*by).orderBy(*order)))


def page_index(files: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From ``vol, file_order, etext, content``: (vol, page) to etext (the last file wins), (vol, etext) to first
    and last page, and (vol, etext, milestone).
    """
    tags = files.select("vol", "file_order", "etext", F.explode(F.regexp_extract_all("content", F.lit(r'<(?:\w+:)?pb[^>]*\bn="(\d+)"'), F.lit(1))).alias("n")).withColumn("page", F.col("n").cast("int"))
    pages = tags.groupBy("vol", "page").agg(F.max_by("etext", "file_order").alias("etext"))
    spans = tags.groupBy("vol", "etext").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"))
    marks = files.select("vol", "etext", F.explode(F.regexp_extract_all("content", F.lit(r'<(?:\w+:)?milestone[^>]*\bxml:id="([^"]+)"'), F.lit(1))).alias("milestone")).distinct()
    return pages, spans, marks


def coordinates(rows: DataFrame, pages: DataFrame, spans: DataFrame, marks: DataFrame, is_start: bool) -> DataFrame:
    """``coord`` and ``issue`` of rows with ``vol, page, shared`` (page of the neighbour that may share it).

    The shared-page test comes before first or last page: milestone, bare etext, or beginning or end of page.
    """
    at = rows.join(pages, ["vol", "page"], "left").join(spans, ["vol", "etext"], "left")
    at = at.withColumn("_mark", milestone_id(F.col("page")))
    at = at.join(marks.select("vol", "etext", F.col("milestone").alias("_mark"), F.lit(True).alias("_known")), ["vol", "etext", "_mark"], "left")
    etext = F.col("etext").cast("string")
    shares = F.coalesce(F.col("shared") == F.col("page"), F.lit(False))
    edge = F.col("page") == F.col("first_page" if is_start else "last_page")
    coord = F.when(F.col("page").isNull() | F.col("etext").isNull(), "").when(F.col("first_page").isNull(), etext).when(shares, F.concat(etext, F.lit("#"), F.col("_mark"))).when(edge, etext).otherwise(F.concat(etext, F.lit("#bop:" if is_start else "#eop:"), F.col("page").cast("string")))
    issue = F.when(F.col("page").isNotNull() & F.col("etext").isNull(), "PAGE_NOT_FOUND").when(shares & F.col("first_page").isNotNull() & F.col("_known").isNull(), "MILESTONE_MISSING")
    return at.withColumn("coord", coord).withColumn("issue", issue).select(*rows.columns, "coord", "issue")


def convert_outline(rows: DataFrame, pages: DataFrame, spans: DataFrame, marks: DataFrame, order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Outline rows with image numbers turned into coordinates, and issues ``row_idx, label, side, code``.

    ``rows`` has the 18 text columns of ``sources.files.OUTLINE`` and ``row_idx``. All columns stay but
    ``img_start`` and ``img_end``: a number becomes a coordinate (empty where no text holds the page), other text
    becomes empty, and without a numeric volume the cell stays as it is. The neighbours that may share a page are
    the rows before and after on the same level (above 0) of the same volume.
    """
    order = order or ["row_idx"]
    trim = lambda c: F.regexp_replace(F.coalesce(F.col(c), F.lit("")), r"(?U)^\s+|\s+$", "")
    known = rows.select("*", level_of([trim(f"pos{i}") for i in range(1, 6)]).alias("_level"))
    plain = known.select(*order, F.col("_level").alias("level"), *[trim(c).try_cast("int").alias(c) for c in ("vol_start", "vol_end", "img_start", "img_end")])
    beside = neighbours(plain.where("level > 0"), order).select(*order, "prev_end", "next_start")
    plain = plain.join(beside, order, "left")
    out, issues = known, []
    for side, shared in (("start", "prev_end"), ("end", "next_start")):
        vol, img = trim(f"vol_{side}"), trim(f"img_{side}")
        at = coordinates(plain.select(*order, F.col(f"vol_{side}").alias("vol"), F.col(f"img_{side}").alias("page"), F.col(shared).alias("shared")), pages, spans, marks, side == "start")
        out = out.join(at.select(*order, F.col("coord").alias(f"_{side}"), F.col("issue").alias(f"_{side}_issue")), order, "left")
        asked = (img != "") & vol.try_cast("int").isNotNull()
        out = out.withColumn(f"_{side}", F.when(asked, F.coalesce(f"_{side}", F.lit(""))).otherwise(img))
        issues.append(F.when(asked & F.col(f"_{side}_issue").isNotNull(), F.struct(F.lit(side).alias("side"), F.col(f"_{side}_issue").alias("code"))))
    found = out.select("row_idx", "label", F.inline(F.filter(F.array(*issues), lambda x: x.isNotNull())))
    kept = [F.col("_start").alias(c) if c == "img_start" else F.col("_end").alias(c) if c == "img_end" else F.col(c) for c in rows.columns]
    return out.select(*kept), found


def boundary_totals(boundaries: DataFrame, unresolved: DataFrame) -> DataFrame:
    """``total, inserted, unresolved`` of boundary pages and those without a place for a milestone."""
    return boundaries.agg(F.count("*").alias("total")).crossJoin(unresolved.agg(F.count("*").alias("unresolved"))).select("total", (F.col("total") - F.col("unresolved")).alias("inserted"), "unresolved")  # one row each


def place_milestone(page: Column, tag: Column, digits: str = "[༠-༩]+༽", head: str = "༄", mark: str = "༈", close: str = "(?:།[ ]*){3,}", line: str = "<lb/>") -> tuple[Column, Column]:
    """Page text with a milestone at the best place, and the rule (0: none).

    1: before digits and a bracket. 2: before the head sign, on the first line only after five characters.
    3: before the other sign. 4: after three closing strokes.
    """
    find = lambda p: F.regexp_instr(page, F.lit(p))
    lines = F.split(page, line, -1)
    n = len(line)
    first_at = F.instr(F.get(lines, F.lit(1)), head)
    clean_at = F.instr(strip_tags(F.get(lines, F.lit(1))), head)
    in_first = F.when(clean_at > 5, F.length(F.get(lines, F.lit(0))) + n + first_at)
    later = F.aggregate(
        lines,
        F.struct(F.lit(0).alias("i"), F.lit(0).alias("off"), F.lit(0).alias("at")),
        lambda a, x: F.struct((a["i"] + 1).alias("i"), (a["off"] + F.length(x) + n).alias("off"), F.when((a["at"] == 0) & (a["i"] >= 2) & (F.instr(x, head) > 0), a["off"] + F.instr(x, head)).otherwise(a["at"]).alias("at")),
    )["at"]
    one, three, four = find(digits), F.instr(page, mark), find(close)
    two = F.coalesce(in_first, F.when(later > 0, later), F.lit(0))
    rule = F.when(one > 0, 1).when(two > 0, 2).when(three > 0, 3).when(four > 0, 4).otherwise(0)
    at = F.when(one > 0, one).when(two > 0, two).when(three > 0, three).when(four > 0, four + F.length(F.regexp_substr(page, F.lit(close))))
    return F.when(rule == 0, page).otherwise(F.concat(F.substr(page, F.lit(1), at - 1), tag, F.substr(page, at))), rule


def numbered_pages(docs: DataFrame) -> DataFrame:
    """``doc_id, vol, seq, pb, page, part``: texts split before each numbered page break; ``pb`` is the break (empty for
    what is before the first) and ``part`` what follows it.
    """
    rows = docs.select("doc_id", "vol", F.posexplode(F.split("text", r'(?=<pb n="\d+"/>)', -1)).alias("seq", "part"))
    pb = F.regexp_extract("part", r'^<pb n="\d+"/>', 0)
    return rows.select("doc_id", "vol", "seq", pb.alias("pb"), F.regexp_extract("part", r'^<pb n="(\d+)"/>', 1).try_cast("int").alias("page"), F.substr(F.col("part"), F.length(pb) + 1).alias("part"))


def milestones_in_text(docs: DataFrame, boundaries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id, vol, text`` with a milestone on each page of the volume's boundary set, and unresolved pages."""
    rows = numbered_pages(docs).join(boundaries.select("vol", "page").distinct().withColumn("_due", F.lit(True)), ["vol", "page"], "left")
    tag = F.concat(F.lit('<milestone xml:id="'), milestone_id(F.col("page")), F.lit('" unit="section"/>'))
    placed, rule = place_milestone(F.col("part"), tag)
    rows = rows.withColumn("rule", F.when(F.col("_due"), rule)).withColumn("new", F.concat("pb", F.when(F.col("_due"), placed).otherwise(F.col("part"))))
    out = rows.groupBy("doc_id", "vol").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "new"))), lambda x: x["new"]), "").alias("text"))
    unresolved = rows.where("rule = 0").select("doc_id", "vol", "page", F.left(strip_tags(F.col("part")), F.lit(200)).alias("preview"))
    return out, unresolved


def titled(units: DataFrame, titles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``units`` (``ut_id, vol, page`` and more) with the ``title`` that starts on their page, and issues.

    ``titles``: ``vol, page, title, row_idx``; of several at one page the last counts. Without one the unit's id is
    the title, with an issue.
    """
    known = last_wins(titles.select("vol", "page", "title", "row_idx"), ["vol", "page"], "row_idx").select("vol", "page", "title")
    rows = units.join(known, ["vol", "page"], "left")
    issues = rows.where("title is null").select(F.col("ut_id").alias("doc_id"), F.lit("MISSING_TITLE").alias("code"), F.concat_ws(":", F.col("vol").cast("string"), F.col("page").cast("string")).alias("detail"))
    return rows.withColumn("title", F.coalesce("title", "ut_id")).select(*units.columns, "title"), issues


def mid_page_start(page: Column, sign: str = "༅") -> Column:
    """Whether the sign is on any line after the first."""
    lines = F.split(page, "\n", -1)
    return F.exists(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), lambda x: x.contains(sign))


def is_title_page(page: Column) -> Column:
    return F.size(F.filter(F.split(page, "\n", -1), lambda x: x.rlike(r"(?U)\S"))) <= 2


def triage(cases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ambiguous ends (``vol, end_page, next_page_text``): corrections (end one later), and cases for review.

    A title page after the end needs neither.
    """
    text = F.col("next_page_text")
    open_ = cases.where(~is_title_page(text))
    return open_.where(mid_page_start(text)).select("vol", F.col("end_page").alias("old_end_page"), (F.col("end_page") + 1).alias("new_end_page")), open_.where(~mid_page_start(text))


def review_text(cases: DataFrame) -> DataFrame:
    """``case_no, text`` of unresolved cases ``folder, title, next_title, img_start, img_end, next_start, next_end,
    vol, page_text``: what a reader needs to decide, with the line to copy if the text goes on.
    """
    show = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rule = F.lit("=" * 80)
    lines = [
        rule, F.concat(F.lit("Folder: "), show("folder")), F.concat(F.lit("Text: "), show("title"), F.lit(" ("), show("img_start"), F.lit("-"), show("img_end"), F.lit(")")),
        F.concat(F.lit("Next: "), show("next_title"), F.lit(" ("), show("next_start"), F.lit("-"), show("next_end"), F.lit(")")),
        F.concat(F.lit("If the text goes on to the next page: "), F.concat_ws(",", show("vol"), show("img_end"), show("next_start"))),
        F.coalesce(F.col("page_text"), F.lit("[page not found]")), rule,
    ]
    numbered = ranked(cases, ["vol", "img_end", "folder"], [], "case_no")
    return numbered.select("case_no", F.concat_ws("\n", *lines).alias("text"))
