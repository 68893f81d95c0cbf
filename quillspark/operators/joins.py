"""Joins by position, by exact set, by range and by prefix, and lookups with defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.session import cut


def ranked(df: DataFrame, order: list[str], by: list[str], name: str = "_rank") -> DataFrame:
    """Row number by ``order`` within ``by``. Without ``by``, rows are dealt by ranges of ``order`` and numbered in
    their partition; that table is written once, and its numbers are shifted by the rows of the partitions before,
    so no task gets all rows and every reader sees the same numbers. Ties are dealt by a hash of the row.
    """
    if by:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    spark = df.sparkSession
    hashed = [f"`{f.name}`" for f in df.schema if not _has_map(f.dataType)]
    keys = [*order, F.xxhash64(*hashed)]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("__dealt", F.monotonically_increasing_id()), "ranked")
    part, place = F.shiftright("__dealt", 33).cast("int"), F.col("__dealt").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r["p"]: r["n"] for r in dealt.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}  # a row per partition
    before = [0]
    for k in range(max(sizes, default=0)):
        before.append(before[-1] + sizes.get(k, 0))
    return dealt.withColumn(name, (place + 1 + F.get(F.lit(before), part)).cast("long")).drop("__dealt")


def _has_map(kind) -> bool:
    """Whether a type holds a map, which can't be hashed."""
    return "map<" in kind.simpleString() or "variant" in kind.simpleString()


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str], size: str, how: str = "inner", share: int = 4, total: int | None = None) -> DataFrame:
    """``rows`` with their row of ``table`` (one per key; column ``size``: rows that have the key), hot keys spread.

    A key is hot if it has more than a ``share``-th of an even partition's rows. There are at most ``share`` times
    as many hot keys as shuffle partitions, so they are broadcast; rows of a hot key get a salt, and its row of
    ``table`` is repeated for each salt. Only the columns of ``table`` beyond the keys and ``size`` are added.
    ``total``: the sum of ``size``, if it is known; else it is found in a pass of its own.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = table.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] if total is None else total
    least = max(1, n // (share * parts))
    salts = F.ceil(F.col(size) / least).cast("int")
    hot = table.where(F.col(size) > least).select(*keys, salts.alias("__salts"))
    salted = rows.join(F.broadcast(hot), keys, "left")  # at most share times the shuffle partitions
    other = [F.col(c) for c in rows.columns if c not in keys]
    salt = F.when(F.col("__salts").isNotNull(), F.pmod(F.xxhash64(*other) if other else F.lit(0), "__salts")).otherwise(0).cast("int")
    salted = salted.withColumn("__salt", salt).drop("__salts")
    repeated = table.withColumn("__salt", F.explode(F.when(F.col(size) > least, F.sequence(F.lit(0), salts - 1)).otherwise(F.array(F.lit(0))))).drop(size)
    return salted.join(repeated, [*keys, "__salt"], how).drop("__salt")


def zip_join(left: DataFrame, right: DataFrame, left_order: list[str], right_order: list[str], by: list[str] | None = None, leftovers: bool = False) -> DataFrame:
    """Rows of the same position side by side, cut to the shorter side, or with ``leftovers`` of either side."""
    by = by or []
    a, b = ranked(left, left_order, by), ranked(right, right_order, by)
    return a.join(b, [*by, "_rank"], "full" if leftovers else "inner").withColumnRenamed("_rank", "position")


def left_default(left: DataFrame, lookup: DataFrame, on: list[str], defaults: dict) -> DataFrame:
    """Left lookup with a default for rows without a match."""
    out = left.join(lookup, on, "left")
    for name, value in defaults.items():
        out = out.withColumn(name, F.coalesce(F.col(name), F.lit(value)))
    return out


def last_wins(df: DataFrame, key: list[str], order: Column | str) -> DataFrame:
    """One row per key: the last by ``order``."""
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(*key, "_row.*")


def with_membership(left: DataFrame, members: DataFrame, on: list[str], flag: str = "found") -> DataFrame:
    """``left`` with a flag whether its key is among ``members``."""
    known = members.select(*on).distinct().withColumn(flag, F.lit(True))
    return left.join(known, on, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def range_lookup(points: DataFrame, ranges: DataFrame, by: list[str], at: str, start: str, end: str) -> DataFrame:
    """Each point with the range of its group that holds it: a window over both, ordered by place, so that no
    group is multiplied. Ranges of a group must not overlap. Unmatched points get nulls.
    """
    rest = [c for c in ranges.columns if c not in by]
    both = points.select(*by, F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.struct(*points.columns).alias("_p"), F.lit(None).cast(ranges.select(F.struct(*rest)).schema[0].dataType).alias("_r")).unionByName(
        ranges.select(*by, F.col(start).alias("_at"), F.lit(0).alias("_kind"), F.struct(*rest).alias("_r")), allowMissingColumns=True
    )
    w = Window.partitionBy(*by).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    got = both.withColumn("_r", F.last("_r", ignorenulls=True).over(w)).where("_kind = 1")
    got = got.withColumn("_r", F.when(F.col("_r")[end] >= F.col("_at"), F.col("_r")))
    return got.select("_p.*", "_r.*")


def prefix_join(bases: DataFrame, stems: DataFrame, base: str, stem: str) -> DataFrame:
    """Stems that are a base, or a base, a hyphen and more: an equi-join on every prefix that ends before a hyphen."""
    parts = F.split(F.col(stem), "-")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "-"))
    return stems.withColumn("_base", F.explode(prefixes)).join(bases.withColumn("_base", F.col(base)), "_base").drop("_base")


def context_pages(asked: DataFrame, pages: DataFrame, by: list[str], at: str, context: int) -> DataFrame:
    """Pages within ``context`` of an asked one, as an equi-join on the few neighbours of each."""
    near = asked.withColumn("_page", F.explode(F.sequence(F.col(at) - context, F.col(at) + context)))
    return near.join(pages.withColumnRenamed("page", "_page"), [*by, "_page"]).withColumnRenamed("_page", "page")


def page_texts(asked: DataFrame, pages: DataFrame, by: list[str], at: str, context: int = 1) -> DataFrame:
    """``context_pages`` with the page's ``text`` without tags and trimmed; of pages with one number the first by
    ``seq`` counts.
    """
    first = pages.groupBy(*by, "page").agg(F.min_by("text", "seq").alias("text"))
    clean = F.regexp_replace(F.regexp_replace("text", "<[^>]+>", ""), r"(?U)^\s+|\s+$", "")
    return context_pages(asked, first.withColumn("text", clean), by, at, context)
