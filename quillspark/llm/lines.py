"""Line dedup: a suffix array over line ids by distributed prefix doubling.

Each non-blank line is a position of the corpus-wide sequence; documents never run into each other. Round 0
ranks positions by their line's digest, and round k ranks runs of 2^k lines by the pair of ranks of their halves.
Ranks are numbers in the order of what they stand for, found by sorting the distinct pairs in ranges, so after a
round the ranks order all suffixes by their first 2^k lines. Positions of one rank are the longest-common-prefix
interval of that depth; a position alone in its class is a unique suffix and leaves, and doubling goes on until
none is left. In an interval the first position (document, line) stays, and the runs that start at the others are
later copies. Runs of ``min_lines`` lines are two overlapping halves of the deepest round that is not longer; the
intervals of the longer rounds say how far each copy goes.
"""

from __future__ import annotations

import functools

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import common
from quillspark.operators import joins

#: Lines of the shortest run whose later copies go.
MIN_LINES = 2
#: Rows that one task can take, whatever their class: fewer aren't spread.
FEW = 100_000
BLANK = " \t\r\f\v"


def digests(text: str | Column = "text") -> Column:
    """Two hashes of each non-blank line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, BLANK, "") != "")
    return F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b")))


def intervals(docs: DataFrame, min_lines: int = MIN_LINES) -> list[tuple[int, DataFrame]]:
    """``(length, doc, tie, p, rank, later)`` for each depth of the suffix array from ``min_lines`` on.

    ``docs``: ``doc, tie, text``, each pair of ``doc`` and ``tie`` once; their order is the corpus order. Only
    positions whose run of that many lines occurs elsewhere too are rows; ``later``: an earlier one has it.
    """
    base = docs.select("doc", "tie", F.posexplode(digests()).alias("p", "x")).select("doc", "tie", "p", F.col("x.a").alias("r1"), F.col("x.b").alias("r2"))

    def ranked(rows: DataFrame, most: int | None = None) -> DataFrame:
        """Classes are summed up before rows meet them; rows of a class that many have are spread. ``most``: a bound
        of the rows, if one is known.
        """
        classes = rows.groupBy("r1", "r2").agg(F.min(F.struct("doc", "tie", "p")).alias("first"), F.count("*").alias("n")).where("n > 1")
        classes = joins.ranked(classes, ["r1", "r2"], [], "rank")
        out = common.spread_join(rows, classes, ["r1", "r2"], "n", total=most) if most is None or most > FEW else rows.join(classes, ["r1", "r2"])
        return out.select("doc", "tie", "p", "rank", (F.col("first") != F.struct("doc", "tie", "p")).alias("later"))

    def paired(rows: DataFrame, step: int) -> DataFrame:
        """Each run with the one that starts ``step`` lines on."""
        left, right = rows.alias("a"), rows.alias("b")
        same = F.col("a.doc").eqNullSafe(F.col("b.doc")) & (F.col("a.tie") == F.col("b.tie")) & (F.col("a.p") + step == F.col("b.p"))
        return left.join(right, same).select("a.doc", "a.tie", "a.p", F.col("a.rank").alias("r1"), F.col("b.rank").alias("r2"))

    now, length, found = common.cut(ranked(base), "ranks"), 1, []
    while (n := now.count()):
        if length >= min_lines:
            found.append((length, now))
        step = length if length >= min_lines or 2 * length <= min_lines else min_lines - length
        now = common.cut(ranked(paired(now, step), n), "ranks")
        length += step
    return found


def later_starts(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """``doc, tie, p, length``: starts of runs that an earlier position has too, with the longest depth that says so."""
    found = [rows.where("later").select("doc", "tie", "p", F.lit(length).alias("length")) for length, rows in intervals(docs, min_lines)]
    if not found:
        return docs.select("doc", "tie", F.lit(0).alias("p"), F.lit(0).alias("length")).limit(0)
    return functools.reduce(DataFrame.unionByName, found).groupBy("doc", "tie", "p").agg(F.max("length").alias("length"))


def keep_lines(text: str, starts: list[tuple[int, int]]) -> tuple[str, int, int]:
    """Text without the lines of the runs (start, length); lines and maximal runs removed."""
    gone = {p + k for p, n in starts for k in range(n)}
    out, p = [], 0
    for line in text.split("\n"):
        if line.strip(BLANK):
            if p not in gone:
                out.append(line)
            p += 1
        else:
            out.append(line)
    return "\n".join(out), len(gone), sum(p - 1 not in gone for p in gone)


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """``row struct<all columns of docs>, text`` without later copies, and ``kept, removed, runs`` (lines and runs).

    A run of ``min_lines`` non-blank lines or more that occurs at an earlier place too (by doc_id, then a hash of
    the text, then line) is deleted, so the first copy of a maximal repeated run stays. Blank lines stay. Null
    text stays null. Rows that repeat both id and text share one result. A null doc_id comes first. An empty
    table gives an empty result.
    """
    common.bounded_batches(docs.sparkSession)
    tie = F.xxhash64("text")
    texts = docs.where("text is not null").select(F.col("doc_id").alias("doc"), tie.alias("tie"), "text")
    if texts.groupBy("doc", "tie").count().where("count > 1").limit(1).count():
        texts = texts.dropDuplicates(["doc", "tie"])
    starts = later_starts(texts, min_lines).groupBy("doc", "tie").agg(F.collect_list(F.struct("p", "length")).alias("starts"))  # a text's own lines

    @F.arrow_udf("struct<text: string, removed: int, runs: int>")
    def kept(text: pa.Array, starts: pa.Array) -> pa.Array:
        out = [keep_lines(t, [(x["p"], x["length"]) for x in s]) if s else None for t, s in zip(text.to_pylist(), starts.to_pylist())]
        return pa.StructArray.from_arrays([pa.array([x and x[i] for x in out], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32()))], ["text", "removed", "runs"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), tie.alias("tie"))
    out = rows.alias("r").join(starts.alias("s"), F.col("r.row.doc_id").eqNullSafe(F.col("s.doc")) & (F.col("r.tie") == F.col("s.tie")), "left").select("row", "starts")
    text = F.col("row")["text"]
    out = out.withColumn("done", kept(F.when(F.col("starts").isNotNull(), text), F.col("starts")))
    removed = F.coalesce("done.removed", F.lit(0))
    lines = F.coalesce(F.size(digests(text)), F.lit(0))
    return out.select("row", F.when(F.col("starts").isNull(), text).otherwise(F.col("done.text")).alias("text"), (lines - removed).alias("kept"), removed.alias("removed"), F.coalesce("done.runs", F.lit(0)).alias("runs"))


def without_copies(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """The columns of ``docs``, whatever their names, with ``text`` as ``dedup_lines`` leaves it."""
    out = dedup_lines(docs, min_lines)
    return out.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    out = dedup_lines(docs)
    return out.select("row.doc_id", F.col("kept").cast("long").alias("n_kept"), F.col("removed").cast("long").alias("n_removed"), F.col("runs").cast("long").alias("n_runs"), F.sha2(common.text_or_empty(), 256).alias("kept_sha256"))


#: The same rows in SQL: pairs of neighbouring non-blank lines, all but the first of each kind removed.
OP3_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents
), marked AS (
  SELECT *, translate(line, concat(' ', chr(9), chr(13), chr(12), chr(11)), '') <> '' AS filled FROM lines
), numbered AS (
  SELECT *, CASE WHEN filled THEN sum(CAST(filled AS INT)) OVER (PARTITION BY doc_id ORDER BY line_no) END AS p FROM marked
), pairs AS (
  SELECT doc_id, p, line, lead(line) OVER (PARTITION BY doc_id ORDER BY p) AS next FROM numbered WHERE filled
), starts AS (
  SELECT doc_id, p, row_number() OVER (PARTITION BY line, next ORDER BY doc_id, p) AS k FROM pairs WHERE next IS NOT NULL
), gone AS (
  SELECT doc_id, p FROM starts WHERE k > 1 UNION SELECT doc_id, p + 1 FROM starts WHERE k > 1
), kept AS (
  SELECT n.doc_id, n.line_no, n.line, n.filled, n.p, g.p IS NOT NULL AS removed FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.p = g.p
), runs AS (
  SELECT a.doc_id, count(*) AS n_runs FROM gone a LEFT JOIN gone b ON a.doc_id = b.doc_id AND a.p - 1 = b.p WHERE b.p IS NULL GROUP BY a.doc_id
), each AS (
  SELECT doc_id, count(*) FILTER (WHERE filled AND NOT removed) AS n_kept, count(*) FILTER (WHERE removed) AS n_removed,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT removed), '')) AS kept_sha256 FROM kept GROUP BY doc_id
)
SELECT d.doc_id, coalesce(e.n_kept, 0) AS n_kept, coalesce(e.n_removed, 0) AS n_removed, coalesce(r.n_runs, 0) AS n_runs, coalesce(e.kept_sha256, sha256('')) AS kept_sha256
FROM documents d LEFT JOIN each e ON d.doc_id = e.doc_id LEFT JOIN runs r ON d.doc_id = r.doc_id
"""
