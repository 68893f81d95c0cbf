"""Shared pieces of the corpus operators: loading, lineage cuts, components, Arrow helpers."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.operators.joins import spread_join  # noqa: F401
from quillspark.session import cut, drop_cut, shared_dir, ship  # noqa: F401

#: Rows and bytes in one Arrow batch, so that a batch of long texts stays small.
BATCH_ROWS, BATCH_BYTES = 2000, 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small for the Python workers of this session, which get this package."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Rows of two or three numbers up to which a table is broadcast.
SMALL = 200_000


def small(table: DataFrame) -> DataFrame:
    """A cut table of short rows with the broadcast hint if it is small; else it is left to a shuffled join."""
    return F.broadcast(table) if table.limit(SMALL + 1).count() <= SMALL else table


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(u, v)`` by alternating large-star and small-star rounds.

    Returns ``node, root`` (root: the smallest node reachable) for every node with a link. Nothing is
    collected but two numbers per round. Loops and repeated links are ignored.
    """

    def signature(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())

    now = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = signature(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
        large = spread_join(both, low, ["u"], "n", total=2 * seen[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        kept = large.groupBy("u").agg(F.min("v").alias("v"))
        before, now = now, cut(small.union(kept).where("u <> v").distinct(), "edges")
        drop_cut(before)
        last, seen = seen, signature(now)
        if seen == last:
            break
    else:
        raise RuntimeError("components did not settle")
    pairs = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()


def runs(it, keys: list[str], rows: int = 200_000):
    """From batches sorted by ``keys``: tables of at least ``rows`` rows that never cut a key's rows apart."""
    held: list[pa.Table] = []
    n = 0
    for batch in it:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        n += batch.num_rows
        if n < rows:
            continue
        table = pa.concat_tables(held).combine_chunks()
        starts = key_starts([table[k].to_numpy() for k in keys])
        if len(starts) == 1:
            held = [table]
            continue
        yield table.slice(0, starts[-1])
        held = [table.slice(starts[-1])]
        n = held[0].num_rows
    if held:
        yield pa.concat_tables(held).combine_chunks()


def key_starts(cols: list[np.ndarray]) -> np.ndarray:
    """First row of every group of equal adjacent keys."""
    if not len(cols[0]):
        return np.zeros(0, np.int64)
    change = np.zeros(len(cols[0]), bool)
    change[0] = True
    for c in cols:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def cross_segments(a_start, a_len, b_start, b_len):
    """Index pairs of the product of segment i of a with segment i of b, for all i at once."""
    n = a_len * b_len
    seg = np.repeat(np.arange(len(n)), n)
    k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return a_start[seg] + k // b_len[seg], b_start[seg] + k % b_len[seg]


def union_find(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable for each of n nodes along links a-b, by vectorised hooking and jumping."""
    lab = np.arange(n)
    while len(a):
        la, lb = lab[a], lab[b]
        hi, lo = np.maximum(la, lb), np.minimum(la, lb)
        open_ = hi != lo
        if not open_.any():
            break
        a, b, hi, lo = a[open_], b[open_], hi[open_], lo[open_]
        np.minimum.at(lab, hi, lo)
        while True:
            up = lab[lab]
            if (up == lab).all():
                break
            lab = up
    return lab


def release() -> None:
    """Give free memory back to the system: workers live on, and what they hold at most would add up over stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))
