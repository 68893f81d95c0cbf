"""SimHash of 4-word shingles and near-duplicate components by anchor-point covering.

Anchors. The 64 bits fall into blocks, each with its own covering code: a Hamming code of covering radius 1 on
some of its bits and every point on the others, or every point as an anchor (radius 0). Each block has a
threshold, and all thresholds plus one sum up to 5: two fingerprints that differ in at most 4 bits differ by
no more than its threshold in some block. A fingerprint's home in a block is its nearest anchor; it is
replicated to every anchor within covering radius + threshold, so such a pair meets at the home of either.
The widths of the blocks follow from the number of fingerprints (``blocks_for``): wide blocks need more
replicas of each, narrow ones more comparisons at each anchor.
Homes of a crowded anchor are dealt out in bounded chunks, and its replicas stream past each chunk. A task
keeps a forest of the links that it finds, so output is linear in the rows of an anchor, whatever the number
of links.
"""

from __future__ import annotations

import functools
import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import common

THRESHOLD = 4
#: Schemes of blocks (first bit, bits, bits under the Hamming code, threshold), from few replicas to many.
SCHEMES = (
    ((0, 24, 15, 1), (24, 24, 15, 1), (48, 16, 0, 0)),
    ((0, 32, 31, 2), (32, 32, 31, 1)),
)
#: Cost of a replica against that of a comparison: a row is shuffled and sorted, two numbers are compared in an array.
ROW_COST = 1000
#: Homes of one anchor that a group of rows holds at most.
CROWD = 4096


def simhash(text: str | None, words: int = 4, seed: int = 42) -> int:
    """Bit set where it is set in over half of the shingle hashes; no word: 0."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    size = np.fromiter(map(len, tokens), np.int64, len(tokens))
    start = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    k = min(words, len(tokens))
    lo, hi = start[: len(tokens) - k + 1].tolist(), (start + size)[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones, n = np.zeros(64, np.int64), len(lo)
    for at in range(0, n, 4096):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(lo[at : at + 4096], hi[at : at + 4096])], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int32)
    bits = np.packbits(ones * 2 > n)
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp long`` (the 64 bits, signed) of every whole text; null text has fingerprint zero."""

    def work(batches):
        for batch in batches:
            fp = np.array([simhash(x.as_py()) for x in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])
        common.release()

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(work, "doc_id long, fp long")


@functools.lru_cache(maxsize=None)
def syndrome_tables(bits: int) -> np.ndarray:
    """Syndromes of the values of each byte of a Hamming code's words."""
    values = np.arange(256, dtype=np.uint32)
    out = np.zeros((-(-bits // 8), 256), np.uint32)
    for i in range(bits):
        out[i // 8] ^= np.where(values >> (i % 8) & 1, np.uint32(i + 1), np.uint32(0))
    return out


def syndrome(part: np.ndarray, bits: int) -> np.ndarray:
    """Zero for codewords, else the number (from 1) of the bit whose flip leads to one."""
    out = np.zeros(len(part), np.uint32)
    low = part & np.uint32((1 << bits) - 1)
    for k, table in enumerate(syndrome_tables(bits)):
        out ^= table[low >> np.uint32(8 * k) & np.uint32(255)]
    return out


def anchors(part: np.ndarray, bits: int, coded: int, threshold: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Home anchor of each value, and (rows, anchors) of the anchors within covering radius + threshold."""
    part = part.astype(np.uint32)
    rows = np.arange(len(part))
    radius = 1 if coded else 0
    mine = syndrome(part, coded) if coded else np.zeros(len(part), np.uint32)
    home = part ^ np.where(mine > 0, np.uint32(1) << np.maximum(mine, 1) - np.uint32(1), np.uint32(0)).astype(np.uint32)
    reach = []
    for d in range(threshold + radius + 1):
        for c in itertools.combinations(range(bits), d):
            flip, moved = 0, 0
            for i in c:  # a flip changes the syndrome by its bit's number
                flip |= 1 << i
                moved ^= i + 1 if i < coded else 0
            ok = mine == moved
            reach.append((rows[ok], part[ok] ^ np.uint32(flip)))
    return home, reach


def replicas(bits: int, coded: int, threshold: int) -> float:
    """Mean number of anchors within reach of a value."""
    ball = sum(math.comb(bits, d) for d in range(threshold + (1 if coded else 0) + 1))
    return ball / (coded + 1)


def blocks_for(n: int) -> tuple:
    """The scheme with the least cost for n fingerprints: rows dealt, and pairs compared at evenly filled anchors."""

    def cost(scheme) -> float:
        rows = sum(1 + replicas(bits, coded, t) for _, bits, coded, t in scheme)
        pairs = sum(n * replicas(bits, coded, t) * (coded + 1) / 2.0**bits for _, bits, coded, t in scheme)
        return ROW_COST * rows + pairs

    return min(SCHEMES, key=cost)


def dealt(blocks: tuple):
    """Rows ``key, replica, fp`` of every anchor that a fingerprint belongs to."""

    def work(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for b, (first, bits, coded, threshold) in enumerate(blocks):
                part = (fp >> np.uint64(first)) & np.uint64((1 << bits) - 1)
                home, reach = anchors(part, bits, coded, threshold)
                tag = np.int64(b << 32)
                keys = [home.astype(np.int64) | tag] + [a.astype(np.int64) | tag for _, a in reach]
                who = [fp] + [fp[r] for r, _ in reach]
                is_home = [np.zeros(len(fp), np.int8)] + [np.ones(len(r), np.int8) for r, _ in reach]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(is_home)), pa.array(np.concatenate(who).view(np.int64))], ["key", "replica", "fp"])

    return work


def homes(blocks: tuple):
    """Each fingerprint's home in each block."""

    def work(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for b, (first, bits, coded, _) in enumerate(blocks):
                home, _ = anchors((fp >> np.uint64(first)) & np.uint64((1 << bits) - 1), bits, coded, -2)
                yield pa.RecordBatch.from_arrays([pa.array(home.astype(np.int64) | np.int64(b << 32))], ["key"])

    return work


def links(batches):
    """Forest links ``u, v`` among the fingerprints of each (key, tile): homes come first, replicas stream."""
    key = tile = None
    mine = np.zeros(0, np.uint64)  # homes of the group that is open

    def out(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["u", "v"])

    for batch in batches:
        if not batch.num_rows:
            continue
        k, t = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        rep, fp = batch.column(2).to_numpy(), batch.column(3).to_numpy().view(np.uint64)
        starts = common.key_starts([k, t])
        ends = np.append(starts[1:], len(k))
        if key == k[0] and tile == t[0] and len(mine):  # go on with the open group
            fp, rep = np.concatenate((mine, fp)), np.concatenate((np.zeros(len(mine), rep.dtype), rep))
            starts[1:] += len(mine)
            ends += len(mine)
        key, tile = k[-1], t[-1]
        first_replica = np.concatenate(([0], np.cumsum(rep == 0)))
        n_home = first_replica[ends] - first_replica[starts]
        mine = fp[starts[-1] : starts[-1] + n_home[-1]]
        n_rep = ends - starts - n_home
        dense = n_home * n_rep > 1 << 16
        a, b = common.cross_segments(starts[~dense], n_home[~dense], (starts + n_home)[~dense], n_rep[~dense])
        near = (np.bitwise_count(fp[a] ^ fp[b]) <= THRESHOLD) & (fp[a] != fp[b])
        found = [(fp[a[near]], fp[b[near]])]
        for s, h, r in zip(starts[dense], n_home[dense], n_rep[dense]):
            found.append(forest(fp[s : s + h], fp[s + h : s + h + r]))
        u, v = (np.concatenate(x) for x in zip(*found))
        if len(u):
            lo, hi = np.minimum(u, v), np.maximum(u, v)
            pairs = np.unique(np.stack((lo, hi), 1), axis=0)
            yield out(np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1]))


def forest(home: np.ndarray, rep: np.ndarray, block: int = 1 << 22) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what lies within the threshold, at most one per fingerprint and block of replicas."""
    found = []
    step = max(1, block // len(home))
    for at in range(0, len(rep), step):
        part = rep[at : at + step]
        i, j = np.nonzero(np.bitwise_count(home[:, None] ^ part[None, :]) <= THRESHOLD)
        if not len(i):
            continue
        lab = common.union_find(i, j + len(home), len(home) + len(part))
        both = np.concatenate((home, part))
        who = np.flatnonzero(lab != np.arange(len(lab)))
        who = who[both[who] != both[lab[who]]]
        found.append((both[who], both[lab[who]]))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    u, v = (np.concatenate(x) for x in zip(*found))
    return u, v


def near_components(fps: DataFrame, crowd: int | None = None, blocks: tuple | None = None) -> DataFrame:
    """``doc_id, fp, component_id`` for rows ``doc_id, fp``: the smallest doc_id reachable over links.

    Equal fingerprints are first collapsed to one; null doc_ids stay in their component but never name it
    unless it has no other. An empty table gives an empty result; repeated doc_ids keep their rows.
    """
    crowd = crowd or CROWD
    fps = common.cut(fps, "fps")
    distinct = common.cut(fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("size")), "distinct")
    blocks = blocks or blocks_for(distinct.count())
    only = distinct.select("fp")
    crowded = common.cut(only.mapInArrow(homes(blocks), "key long").groupBy("key").count().where(F.col("count") > crowd).select("key", F.ceil(F.col("count") / crowd).cast("int").alias("n")), "crowded")
    rows = only.mapInArrow(dealt(blocks), "key long, replica byte, fp long").join(common.small(crowded), "key", "left")
    n = F.coalesce("n", F.lit(1))
    own, other = F.pmod(F.xxhash64("fp"), n).cast("int"), F.pmod(F.xxhash64("fp", F.lit(1)), n).cast("int")
    # a home goes to every tile of its row, a replica to every tile of its column
    tiles = F.when(n == 1, F.array(F.lit(0))).when(F.col("replica") == 0, F.transform(F.sequence(F.lit(0), n - 1), lambda j: own * n + j)).otherwise(F.transform(F.sequence(F.lit(0), n - 1), lambda i: i * n + other))
    placed = rows.select("key", F.explode(tiles).alias("tile"), "replica", "fp")
    met = placed.repartition(common.shuffle_parts(fps.sparkSession), "key", "tile").sortWithinPartitions("key", "tile", "replica")
    linked = common.components(met.mapInArrow(links, "u long, v long"))
    common.drop_cut(crowded)
    linked = common.cut(linked.join(distinct, linked["node"] == distinct["fp"]).select("fp", "root", "first"), "linked")
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("n"))
    named = common.spread_join(linked, least, ["root"], "n").select("fp", "component_id")
    by_fp = distinct.join(named, "fp", "left").select("fp", "size", F.coalesce("component_id", "first").alias("component_id"))
    return common.spread_join(fps, by_fp, ["fp"], "size").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that are the first of their near-duplicate component, by doc_id and a hash of the text.

    Rows that repeat id and text count as one, and one of them stays. A null doc_id comes first. Null and empty
    texts are near duplicates of each other. Columns of any name pass through; an empty table stays empty.
    """
    common.bounded_batches(docs.sparkSession)
    uid = F.xxhash64("doc_id", "text")
    texts = docs.select(uid.alias("doc_id"), "text")
    fps = common.cut(fingerprints(texts).withColumnRenamed("doc_id", "uid"), "uids")
    groups = near_components(fps.select(F.col("uid").alias("doc_id"), "fp")).select(F.col("doc_id").alias("uid"), "component_id").distinct()
    ids = docs.select(uid.alias("uid"), "doc_id").distinct()
    first = groups.join(ids, "uid").groupBy("component_id").agg(F.min(F.struct("doc_id", "uid")).alias("x"))
    rows = docs.select(uid.alias("uid"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).join(first.select(F.col("x.uid").alias("uid")), "uid", "left_semi")
    if docs.groupBy(uid).count().where("count > 1").limit(1).count():
        rows = rows.dropDuplicates(["uid"])
    return rows.select("row.*")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_components(fingerprints(common.documents(spark, sf_dir)))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
