"""Files and folders of a collection as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.functions.markup import arabic_digits
from quillspark.functions.ordering import natural_key, unit_id


def binary_files(spark: SparkSession, path: str, pattern: str = "*", collection: str | None = None) -> DataFrame:
    """``path, length, content`` of the files below a folder; with ``collection`` only that folder of it is listed."""
    path = path if collection is None else f"{path.rstrip('/')}/{collection}"
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", "length", "content")


def text_files(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """``path, content, sha256, is_utf8``: whole files; bytes that are not UTF-8 give null content."""
    raw = binary_files(spark, path, pattern)
    return raw.select("path", F.try_validate_utf8(F.col("content").cast("string")).alias("content"), F.sha2("content", 256).alias("sha256"), F.is_valid_utf8(F.col("content").cast("string")).alias("is_utf8"))


def collections(files: DataFrame) -> DataFrame:
    """Adds ``ie_id, volume_folder, ve_id, file_name`` from paths ``IE/IE/toprocess/..`` or ``IE/toprocess/..``.

    Where both layouts of a collection exist, the nested one counts.
    """
    name = r"([^/]+)/(?:\1/)?toprocess/(?:([^/]+)/)?([^/]+)$"
    rows = files.withColumn("ie_id", F.regexp_extract("path", name, 1)).where("ie_id <> ''")
    rows = rows.withColumn("volume_folder", F.regexp_extract("path", name, 2)).withColumn("file_name", F.regexp_extract("path", name, 3))
    rows = rows.withColumn("nested", F.col("path").rlike(r"([^/]+)/\1/toprocess/"))
    best = rows.groupBy("ie_id").agg(F.max("nested").alias("best"))
    rows = rows.join(best, "ie_id").where(F.col("nested") == F.col("best")).drop("nested", "best")
    prefix = F.concat("ie_id", F.lit("-"))
    return rows.withColumn("ve_id", F.when(F.col("volume_folder").startswith(prefix), F.substr(F.col("volume_folder"), F.length(prefix) + 1)))


def volumes(files: DataFrame, natural: bool = True, filled: bool = False) -> DataFrame:
    """Volumes of each collection in natural (or plain) order: ``ie_id, ve_id, volume_folder, vol_num``.

    ``filled``: only volumes with a file whose ``content`` is not blank count.
    """
    rows = files.where("ve_id is not null" + " and content rlike '(?U)\\\\S'" * filled).select("ie_id", "ve_id", "volume_folder").distinct()
    order = natural_key(F.col("volume_folder")) if natural else F.col("volume_folder")
    return rows.withColumn("vol_num", F.row_number().over(Window.partitionBy("ie_id").orderBy(order, "volume_folder")))


def units(files: DataFrame) -> DataFrame:
    """Adds ``pos`` (from 1, natural order of file names in a volume) and ``ut_id``."""
    w = Window.partitionBy("ie_id", "ve_id").orderBy(natural_key(F.col("file_name")), "file_name")
    rows = files.where("ve_id is not null").withColumn("pos", F.row_number().over(w))
    return rows.withColumn("ut_id", unit_id(F.col("ve_id"), F.col("pos")))


def side_files(files: DataFrame, suffix: str = ".txt") -> DataFrame:
    """Files that are not sources and not a file manager's droppings."""
    return files.where(~F.col("file_name").endswith(suffix) & (F.col("file_name") != ".DS_Store"))


def count_mismatches(left: DataFrame, right: DataFrame, by: str) -> DataFrame:
    """Issues ``doc_id, code, detail`` of groups with other numbers of rows on the two sides (``2:3``)."""
    counts = [df.groupBy(F.col(by).cast("string").alias("doc_id")).agg(F.count("*").alias(name)) for df, name in ((left, "a"), (right, "b"))]
    both = counts[0].join(counts[1], "doc_id", "full").fillna(0, ["a", "b"])
    return both.where("a <> b").select("doc_id", F.lit("COUNT_MISMATCH").alias("code"), F.concat_ws(":", F.col("a").cast("string"), F.col("b").cast("string")).alias("detail"))


def digest_or_missing(wanted: DataFrame, files: DataFrame, missing: str = "FILE_NOT_FOUND") -> DataFrame:
    """SHA-256 of each wanted path, or a sentinel."""
    have = files.select("path", F.sha2("content", 256).alias("sha256"))
    return wanted.join(have, "path", "left").withColumn("sha256", F.coalesce("sha256", F.lit(missing)))


def is_whole_volume(name: Column, base: str) -> Column:
    return name.rlike(rf"(?i)^{base}-\d+\.(rtf|doc)$")


def unseen(files: DataFrame, manifest: DataFrame, key: str = "path") -> DataFrame:
    """Files whose key is not in the manifest of what is done."""
    return files.join(manifest.select(key), key, "left_anti")


def without(files: DataFrame, denied: DataFrame, key: str = "path") -> DataFrame:
    """Files whose key is not in a denylist; a null key stays."""
    return files.join(denied.select(key).distinct(), key, "left_anti")


def without_prefix(name: Column, prefix: str) -> Column:
    return F.when(name.startswith(prefix), F.substring(name, len(prefix) + 1, 2**30)).otherwise(name)


def is_contents(name: Column) -> Column:
    """Whether a file is a volume's table of contents, by its name."""
    return F.coalesce(name.rlike(r"-0\.[A-Za-z]+$"), F.lit(False))


def source_copies(files: DataFrame, suffix: str = ".txt") -> DataFrame:
    """``path, content`` for ``sinks.write_files``: sources by volume, other files beside them."""
    place = F.when(F.col("file_name").endswith(suffix), F.lit("")).otherwise("other_files/")
    return files.where("file_name <> '.DS_Store'").select(F.concat(F.lit("sources/"), F.coalesce("ve_id", F.lit("")), F.when(F.col("ve_id").isNotNull(), "/").otherwise(""), place, F.col("file_name")).alias("path"), "content")


def blank_pages(spark: SparkSession, path: str) -> DataFrame:
    """Headerless ``path, total, blanks, per_pdf``; rows without three numbers are dropped."""
    rows = spark.read.schema("path string, total string, blanks string, per_pdf string").csv(path)
    rows = rows.select("path", *[F.col(c).try_cast("int").alias(c) for c in ("total", "blanks", "per_pdf")])
    return rows.where("total is not null and blanks is not null")


def pages_by_folder(blanks: DataFrame) -> DataFrame:
    """``folder, file_name, total, blanks, is_contents`` of rows ``path, total, blanks`` with one folder in their path."""
    parts = F.split("path", "/")
    rows = blanks.select(F.get(parts, F.lit(0)).alias("folder"), F.get(parts, F.lit(1)).alias("file_name"), "total", F.coalesce("blanks", F.lit(0)).alias("blanks"))
    return rows.where("file_name is not null").withColumn("is_contents", is_contents(F.col("file_name")))


def keyed_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The named columns of a CSV with a header, in the order asked for; a column that it lacks is null."""
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return rows.select(*[F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns])


def body_pages(content: Column, first: int | None = None, last: int | None = None) -> Column:
    """Pages (from their page break on) of the first paragraph of a TEI body, all or the first or last few."""
    para = F.regexp_extract(content, r"(?s)<(?:\w+:)?body\b.*?<(?:\w+:)?p\b[^>]*>(.*?)</(?:\w+:)?p>", 1)
    pages = F.filter(F.split(para, r"(?=<(?:\w+:)?pb\b[^>]*\bn=)", -1), lambda p: p.rlike("^<"))
    if first is not None:
        return F.slice(pages, F.lit(1), F.lit(first))
    if last is not None:
        return F.slice(pages, F.greatest(F.size(pages) - last, F.lit(0)) + 1, F.lit(last))
    return pages


def page_count(content: Column) -> Column:
    """Numbered page breaks of a TEI file."""
    return F.regexp_count(content, F.lit("<pb n="))


OUTLINE = "rid, pos1, pos2, pos3, pos4, pos5, part_type, label, titles, work, notes, colophon, authorship, identifiers, img_start, img_end, vol_start, vol_end".split(", ")
SHORT_OUTLINE = "level1, level2, level3, part_type, label, title, vol_start, vol_end, page_start, page_end".split(", ")


def outline(spark: SparkSession, path: str, columns: list[str] = OUTLINE) -> DataFrame:
    """A positional outline with one header row; ``row_idx`` keeps the file's order. A missing file: no rows."""
    schema = ", ".join(f"{c} string" for c in columns)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], schema + ", row_idx long")
    rows = spark.read.schema(schema).csv(path, header=True, enforceSchema=True, multiLine=True)
    return rows.withColumn("row_idx", F.monotonically_increasing_id())  # one file, read by one task in order


#: Glyphs that a decoder left as tags in titles, before and after white space is collapsed.
TITLE_GLYPHS = {"[[F5 ]]": "", "[[F1)]]": "", "[[F1 ]]": "", "[[F11(]]": "\u0f3c"}
TITLE_LETTERS = {
    "[[F12#]]": "\u0f62\u0fb1",
    "[[Ededris-vowa,62,\u0f67\u0f71\u0f74\u0f83 or \u0f83\u0f67\u0f75]]": "\u0f67\u0f71\u0f74\u0f83",
    "[[Ededris-vowa,116,\u0f68\u0fa0\u0f72\u0f80 or \u0f68\u0fa0\u0f80\u0f72]]": "\u0f68\u0fa0\u0f80\u0f72",
    "[[F12j]]": "\u0f53\u0fa1\u0fb2",
    "[[F12K]]": "\u0f51\u0fb7\u0f71\u0f74",
}


def toc_rows(lines: DataFrame) -> DataFrame:
    """``folder, number, title, page`` of table-of-contents lines ``folder, line`` that start with a Tibetan digit.

    A leader (two tshegs or more) ends the title, and the page is what comes before the next one, empty without
    a leader. Glyph tags of digits and the hyphen count in pages, those of other signs in titles.
    """
    digits = "\u0f20-\u0f29"
    stripped = F.regexp_replace("line", r"(?U)^\s+|\s+$", "")
    rows = lines.withColumn("line", stripped).where(F.col("line").rlike(f"^[{digits}]"))
    parts = F.split("line", "\u0f0b\u0f0b+")
    head, page = F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)), F.lit(""))
    page = F.replace(F.regexp_replace(page, r"(?U)\[\[F\d(\d)\]\]", "$1"), F.lit("[[F5-]]"), F.lit("-"))
    number = F.regexp_extract(head, f"^[{digits}]+", 0)
    title = F.substr(head, F.length(number) + 1)
    for glyph, sign in TITLE_GLYPHS.items():
        title = F.replace(title, F.lit(glyph), F.lit(sign))
    title = F.regexp_replace(F.regexp_replace(title, "^[\u0f3d ]+|[\u0f3d ]+$", ""), r"(?U)\s+", " ")
    for glyph, sign in TITLE_LETTERS.items():
        title = F.replace(title, F.lit(glyph), F.lit(sign))
    return rows.select("folder", arabic_digits(number).alias("number"), title.alias("title"), arabic_digits(page).alias("page"))
