"""Size-marked text: segments, their simplification, size statistics, size classes and size markup."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.functions.normalize import let
from quillspark.operators.joins import ranked

TAG = r"<fs:(\d+)>"
TSEG, SHAD, OPEN, CLOSE = "་", "།", "༼", "༽"
SEGMENT = "struct<fs: int, content: string>"


#: Segments from which folding goes through Python: folds over arrays copy what they have at each step.
MANY = 2000


def segments(text: Column) -> Column:
    """``array<struct<fs, content>>`` in order; text before the first tag has fs null; empty contents go."""
    parts = F.split(text, r"<fs:(?=\d+>)", -1)
    made = F.transform(
        parts,
        lambda p, i: F.when(i == 0, F.struct(F.lit(None).cast("int").alias("fs"), p.alias("content"))).otherwise(F.struct(F.regexp_extract(p, r"^(\d+)>", 1).cast("int").alias("fs"), F.regexp_replace(p, r"^\d+>", "").alias("content"))),
    )
    return F.filter(made, lambda s: s["content"] != "")


def _last(acc: Column) -> Column:
    return F.element_at(acc, -1)


def _replace_last(acc: Column, fs: Column, content: Column) -> Column:
    return F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(fs.alias("fs"), content.alias("content"))))


def _append(acc: Column, s: Column) -> Column:
    return F.concat(acc, F.array(s))


def simplify(text: Column) -> Column:
    """Text with fewer size tags: a lone opening bracket takes the next size, a closing one stays with what is
    before it, segments without a separator merge backwards, neighbours of one size merge.
    """
    empty = F.array().cast(f"array<{SEGMENT}>")

    def backwards(acc: Column, s: Column) -> Column:
        apart = s["content"].contains(TSEG) | s["content"].contains(SHAD) | s["content"].endswith(CLOSE)
        first = F.size(acc) == 0
        blank = ~s["content"].rlike(r"(?U)\S")
        no_size = F.struct(F.lit(None).cast("int").alias("fs"), s["content"].alias("content"))
        return F.when(~apart & ~first, _replace_last(acc, _last(acc)["fs"], F.concat(_last(acc)["content"], s["content"]))).when(~apart & blank, _append(acc, no_size)).otherwise(_append(acc, s))

    def equal_sizes(acc: Column, s: Column) -> Column:
        same = (F.size(acc) > 0) & _last(acc)["fs"].eqNullSafe(s["fs"])
        return F.when(same, _replace_last(acc, s["fs"], F.concat(_last(acc)["content"], s["content"]))).otherwise(_append(acc, s))

    def folded(segs: Column) -> Column:
        marked = F.transform(segs, lambda s, i: F.struct(s["fs"].alias("fs"), s["content"].alias("content"), (i == F.size(segs) - 1).alias("last")))
        start = F.struct(empty.alias("done"), F.lit(False).alias("waits"))
        brackets = F.aggregate(marked, start, _bracket, lambda st: st["done"])
        merged = F.aggregate(F.aggregate(brackets, empty, backwards), empty, equal_sizes)
        return F.array_join(F.transform(merged, lambda s: F.concat(F.when(s["fs"].isNull(), "").otherwise(F.concat(F.lit("<fs:"), s["fs"].cast("string"), F.lit(">"))), s["content"])), "")

    @F.arrow_udf("string")
    def by_python(x: pa.Array) -> pa.Array:
        return pa.array([None if t is None else simplified(t) for t in x.to_pylist()], pa.string())

    tags = F.regexp_count(text, F.lit(TAG))
    long = by_python(F.when(tags > MANY, text))
    return F.when(tags > MANY, long).otherwise(F.coalesce(let(segments(text), lambda segs: F.when(F.size(segs) > 0, folded(segs))), text))


def simplified(text: str) -> str:
    """The same for one text in Python, in one pass for each rule."""
    parts = re.split(TAG, text)
    segs = [(int(parts[i - 1]) if i else None, parts[i]) for i in range(0, len(parts), 2) if parts[i]]
    if not segs:
        return text
    done: list[list] = []
    waits = False
    for i, (fs, content) in enumerate(segs):
        if waits:
            done.append([fs, [OPEN, content]])
            waits = False
        elif content == OPEN and i + 1 < len(segs):
            waits = True
        elif content.startswith(CLOSE) and done:
            done[-1][1].append(content)
        else:
            done.append([fs, [content]])
    merged: list[list] = []
    for fs, held in done:
        content = "".join(held)
        apart = TSEG in content or SHAD in content or content.endswith(CLOSE)
        if not apart and merged:
            merged[-1][1].append(content)
        else:
            merged.append([fs if apart or content.strip() else None, [content]])
    out, last = [], object()
    for fs, held in merged:
        if fs != last and fs is not None:
            out.append(f"<fs:{fs}>")
        last = fs
        out += held
    return "".join(out)


def _bracket(state: Column, s: Column) -> Column:
    done, waits = state["done"], state["waits"]
    plain = F.struct(s["fs"].alias("fs"), s["content"].alias("content"))
    merged = F.struct(s["fs"].alias("fs"), F.concat(F.lit(OPEN), s["content"]).alias("content"))
    lone = (s["content"] == OPEN) & ~s["last"]
    closing = s["content"].startswith(CLOSE) & (F.size(done) > 0)
    next_done = F.when(waits, _append(done, merged)).when(lone, done).when(closing, _replace_last(done, _last(done)["fs"], F.concat(_last(done)["content"], s["content"]))).otherwise(_append(done, plain))
    return F.struct(next_done.alias("done"), (~waits & lone).alias("waits"))


def size_set(text: Column) -> Column:
    """Sorted distinct sizes of a text."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TAG), F.lit(1)), lambda x: x.cast("int"))))


def split_pages(docs: DataFrame, key: str, text: str = "text", sentinel: str = "ZZZZ") -> DataFrame:
    """``key, page_no`` (from 0) and ``page`` of the pages between sentinels; null text has none."""
    return docs.select(key, F.posexplode(F.split(text, sentinel, -1)).alias("page_no", "page"))


def size_counts(docs: DataFrame, key: str, text: str = "text", block_only: bool = True) -> DataFrame:
    """``key, fs, cnt, first_seen, on_first_page``: letters of the target script by size, zeros left out.

    ``block_only``: count U+0F00 to U+0FFF, else every character above U+0F00. The first page ends at the
    second page break; a size is on it if letters of that size are.
    """
    letters = r"[\x{0f00}-\x{0fff}]" if block_only else r"[\x{0f01}-\x{10ffff}]"
    opening = F.filter(segments(F.substring_index(text, "ZZZZ", 2)), lambda s: s["content"].rlike(letters))
    seg = docs.select(key, F.posexplode(segments(F.col(text))).alias("seq", "s"), F.array_distinct(F.transform(opening, lambda s: s["fs"])).alias("first"))
    rows = seg.select(key, "seq", F.col("s.fs").alias("fs"), F.regexp_count("s.content", F.lit(letters)).alias("n"), "first").where("fs is not null and n > 0")
    return rows.groupBy(key, "fs").agg(F.sum("n").alias("cnt"), F.min("seq").alias("first_seen"), F.max(F.array_contains("first", F.col("fs"))).alias("on_first_page"))


def size_profiles(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``place, sizes, n_docs, sample``: size sets by their number of texts (most first), then by the first text.

    ``sample`` is the least ``key`` of a set; texts without sizes don't count.
    """
    sets = docs.select(key, size_set(F.col(text)).alias("sizes")).where(F.size("sizes") > 0)
    found = sets.groupBy("sizes").agg(F.count("*").alias("n_docs"), F.min(key).alias("sample"))
    return ranked(found.withColumn("_few", -F.col("n_docs")), ["_few", "sample"], [], "place").select("place", "sizes", "n_docs", "sample")


def classify(counts: DataFrame, key: str, rule: str = "A", body: tuple[int, int] = (18, 26), ties: str = "smaller") -> DataFrame:
    """``key, fs, cnt, pct, class, confident`` from ``key, fs, cnt`` (and for rule A ``on_first_page``).

    A: regular is the most frequent size in ``body`` (else of all); larger ones are large if on the first
    page, else unsure regular; smaller ones small; a regular size at most 4/5 of the next regular and not
    more frequent turns small; if none is regular any more, the most frequent from 20 to 26 is. B: regular is
    the most frequent; larger ones large if rare or far, else unsure regular; smaller ones small, unsure if
    close. C: like A without pages, confidence and afterthoughts. D: around the most frequent. Ties go to the
    smaller size (rules A to C in a pair of sizes: to the larger), or with ``ties="first"`` to the one whose
    ``first_seen`` is least.
    """
    doc = Window.partitionBy(key)
    c = counts.withColumn("pct", F.col("cnt") / F.sum("cnt").over(doc) * 100).withColumn("n_sizes", F.count("*").over(doc))
    rank = F.struct(F.col("cnt"), -F.col("first_seen" if ties == "first" else "fs"), -F.col("fs"))
    in_body = F.col("fs").between(*body)
    top = F.max_by("fs", rank).over(doc)
    top_body = F.max(F.when(in_body, rank)).over(doc)
    pair_top = F.max_by("fs", F.struct("cnt", "fs")).over(doc)
    body_top = F.coalesce(-top_body["col3"], top)
    regular = {"A": F.when(F.col("n_sizes") == 2, pair_top).otherwise(body_top), "B": F.when(F.col("n_sizes") == 2, pair_top).otherwise(top), "C": F.when(F.col("n_sizes") == 2, pair_top).otherwise(body_top), "D": top}[rule]
    c = c.withColumn("regular_fs", regular)
    larger, same = F.col("fs") > F.col("regular_fs"), F.col("fs") == F.col("regular_fs")
    if rule == "A":
        kind = F.when(same, "regular").when(larger, F.when(F.col("on_first_page"), "large").otherwise("regular")).otherwise("small")
        sure = F.when(larger, F.col("on_first_page") & (F.col("pct") <= 15)).otherwise(True)
    elif rule == "B":
        two = F.col("n_sizes") == 2
        up, down = F.col("fs") / F.col("regular_fs"), F.col("regular_fs") / F.col("fs")
        kind = F.when(same, "regular").when(larger, F.when(two | (F.col("pct") < 10) | (up > 1.15), "large").otherwise("regular")).otherwise("small")
        sure = F.when(same, True).when(larger & two, F.col("pct") <= 15).when(larger, F.col("pct") < 10).when(two, True).otherwise(down > 1.2)
    else:
        kind = F.when(same, "regular").when(larger, "large").otherwise("small")
        sure = F.lit(True)
    c = c.withColumn("class", kind).withColumn("confident", sure)
    if rule == "A":
        up = Window.partitionBy(key, "class").orderBy("fs")
        shrinks = (F.col("class") == "regular") & (F.lead("fs").over(up) / F.col("fs") >= 1.25) & (F.lead("cnt").over(up) >= F.col("cnt"))
        c = c.withColumn("shrinks", F.coalesce(shrinks, F.lit(False)))
        c = c.withColumn("class", F.when(F.col("shrinks"), "small").otherwise(F.col("class"))).withColumn("confident", F.col("confident") | F.col("shrinks"))
        mid = F.max(F.when(F.col("fs").between(20, 26), rank)).over(doc)
        saved = (F.max((F.col("class") == "regular").cast("int")).over(doc) == 0) & (F.col("fs") == F.coalesce(-mid["col3"], top))
        c = c.withColumn("saved", saved).withColumn("class", F.when(F.col("saved"), "regular").otherwise(F.col("class"))).withColumn("confident", F.col("confident") | F.col("saved"))
    return c.select(key, "fs", "cnt", "pct", "class", "confident")


def apply_size_markup(text: Column, classes: Column, pages: bool = True) -> Column:
    """Size tags to ``<large>`` and ``<small>`` by a map of size to class (default regular).

    Spaces beside a tag move out of the element, an element ends before a page break and opens again after
    it, and empty elements go. Without ``pages`` page breaks are text like any other. Tags alone leave nothing.
    """

    def kind(s: Column) -> Column:
        known = F.when(s["fs"].isNull(), "regular").otherwise(F.coalesce(F.try_element_at(classes, s["fs"]), F.lit("regular")))
        return F.struct(F.when(known.isin("large", "small"), known).otherwise("regular").alias("k"), s["content"].alias("c"))

    def islands(kinds: Column) -> Column:
        """Runs of one class, found by where they start, so that nothing is copied twice."""
        n = F.size(kinds)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(kinds, i)["k"] != F.get(kinds, i - 1)["k"]))
        return let(starts, lambda st: F.transform(st, lambda a, j: F.struct(F.get(kinds, a)["k"].alias("k"), F.array_join(F.transform(F.slice(kinds, a + 1, F.coalesce(F.get(st, j + 1), n) - a), lambda s: s["c"]), "").alias("c"))))

    def outside(x: Column) -> Column:
        """One space, then one page break, on either side of an element's text."""
        head = F.regexp_extract(x["c"], r"(?U)^\s", 0)
        x1 = F.struct(x["k"].alias("k"), head.alias("a"), F.substr(x["c"], F.length(head) + 1).alias("c"))
        return x1

    def closed(x: Column) -> Column:
        tail = F.regexp_extract(x["c"], r"(?U)\s\z", 0)
        return F.struct(x["k"].alias("k"), x["a"].alias("a"), F.left(x["c"], F.length(x["c"]) - F.length(tail)).alias("c"), tail.alias("z"))

    def paged(x: Column) -> Column:
        head = F.when(x["c"].startswith("ZZZZ"), "ZZZZ").otherwise("")
        rest = F.substr(x["c"], F.length(head) + 1)
        tail = F.when(rest.endswith("ZZZZ"), "ZZZZ").otherwise("")
        return F.struct(x["k"].alias("k"), F.concat(x["a"], head).alias("a"), F.left(rest, F.length(rest) - F.length(tail)).alias("c"), F.concat(tail, x["z"]).alias("z"))

    def element(x: Column) -> Column:
        start, end = F.concat(F.lit("<"), x["k"], F.lit(">")), F.concat(F.lit("</"), x["k"], F.lit(">"))
        inner = F.replace(x["c"], F.lit("ZZZZ"), F.concat(end, F.lit("ZZZZ"), start)) if pages else x["c"]
        return F.concat(x["a"], start, inner, end, x["z"])

    def written(x: Column) -> Column:
        chain = let(outside(x), lambda p: let(closed(p), lambda q: let(paged(q), element) if pages else element(q)))
        return F.when(x["k"] == "regular", x["c"]).otherwise(chain)

    made = let(F.transform(segments(text), kind), lambda kinds: F.when(F.size(kinds) > 0, F.array_join(F.transform(islands(kinds), written), "")).when(F.size(kinds) == 0, ""))
    made = F.regexp_replace(F.regexp_replace(made, "<large></large>", ""), "<small></small>", "")
    return F.coalesce(made, text)


def profile_key(sizes: Column) -> Column:
    return F.array_join(sizes, "-")


def match_profiles(docs: DataFrame, registry: DataFrame) -> DataFrame:
    """``docs`` with ``profile`` of the registry row with exactly the same ``sizes`` (first by ``ord``), or null.

    The registry (a row for each known set of sizes, some hundreds) is broadcast: most texts share few sets, and texts
    without sizes all share one, so a join by key would bring them to one task.
    """
    known = registry.groupBy(profile_key(F.col("sizes")).alias("_key")).agg(F.min_by("profile", "ord").alias("profile"))
    return docs.withColumn("_key", profile_key(F.col("sizes"))).join(F.broadcast(known), "_key", "left").drop("_key")


def missing_profiles(docs: DataFrame, registry: DataFrame) -> DataFrame:
    """Size sets not in the registry, numbered on from its highest number: ``profile, sizes, n_docs``."""
    seen = docs.where(F.size("sizes") > 0).groupBy("sizes").agg(F.count("*").alias("n_docs"))
    new = seen.join(registry.select("sizes").distinct(), "sizes", "left_anti")
    last = registry.agg(F.coalesce(F.max(F.regexp_extract("profile", r"(\d+)", 1).try_cast("int")), F.lit(0))).first()[0]  # one number
    new = ranked(new.withColumn("_key", profile_key(F.col("sizes"))).withColumn("_few", -F.col("n_docs")), ["_few", "_key"], [], "k")
    return new.select(F.format_string("profile%03d", F.col("k") + last).alias("profile"), "sizes", "n_docs")


def registry_additions(docs: DataFrame, registry: DataFrame, key: str, rule: str = "A") -> DataFrame:
    """Registry rows ``profile, font_size, classification, confidence, percentage, notes`` for unknown size sets.

    The least ``key`` of a set is its sample, whose letters are counted and classified; a size without letters
    is ``?``. Numbers go on from the registry's highest. Append the rows to the registry's table.
    """
    sets = docs.select(key, "text", size_set(F.col("text")).alias("sizes"))
    new = missing_profiles(sets, registry)
    sample = sets.groupBy("sizes").agg(F.min_by(F.struct(key, "text"), key).alias("s")).select("sizes", "s.*")
    chosen = new.join(sample, "sizes").select("profile", "sizes", F.col("text"))
    classes = classify(size_counts(chosen, "profile"), "profile", rule)
    rows = chosen.select("profile", F.explode("sizes").alias("fs")).join(classes, ["profile", "fs"], "left")
    known = F.col("class").isNotNull()
    return rows.select(
        "profile", F.col("fs").alias("font_size"), F.when(known, F.col("class")).otherwise("?").alias("classification"), F.when(known & F.col("confident"), "").otherwise("?").alias("confidence"),
        F.format_string("%.1f", F.coalesce("pct", F.lit(0.0))).alias("percentage"), F.when(known, "AUTO-ADDED").otherwise("AUTO-ADDED: ERROR").alias("notes"),
    )
