"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

Equal vectors of a label become one weighted class. On a bounded sample, PCA and iterative quantisation learn
rotations whose signs are balanced binary codes. Each code is split into substrings; a substring with the
label is one index table. Only codes go to the tables. Vectors that share an entry of any table and whose whole
codes are within the Hamming distance of pairs at the threshold are candidates, each pair in the first table
where it meets; entries without candidates end there. The original vectors are fetched for the others only and
compared by cosine in double precision. Substring length follows the number of classes, so entries keep their
size; the number of tables follows from the chance that a pair at the threshold agrees on a substring, tried on
sampled pairs. An entry with more than ``CROWD`` classes is dealt into chunks, and every pair of chunks is one
bounded tile.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import common

#: Vectors in the sample that the codes are learned from.
SAMPLE = 20_000
#: Chance that a pair right at the threshold meets in no table.
MISS = 0.005
#: Share of sampled pairs at the threshold whose codes may be further apart than the Hamming distance that is kept.
FAR = 0.001
#: Sampled pairs that the number of tables and the Hamming distance are tried on.
PROBES = 2000
CROWD = 2048


VECTORS = "vec_id long, label long, h1 long, h2 long, dim int, vec binary"


def vectors_of(rows: DataFrame) -> DataFrame:
    """``vec_id, label, h1, h2, dim, vec`` per row; h1 and h2 (128 bits of label and vector) are null where a vector
    can't link (see near_vectors). Labels of any type become hashes.
    """
    wide = "double" in rows.schema["embedding"].dataType.simpleString()
    kind = np.float64 if wide else np.float32
    names = [x.split()[0] for x in VECTORS.split(", ")]

    def work(batches):
        for batch in batches:
            out = []
            for e, label in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                ok = e is not None and label is not None and len(e) and None not in e
                x = np.array(e, np.float64) if ok else None
                if ok and np.isfinite(x).all() and x.any():
                    raw = x.astype(kind).tobytes()
                    digest = np.frombuffer(xxhash.xxh3_128_digest(label.to_bytes(8, "little", signed=True) + raw), np.int64)
                    out.append((int(digest[0]), int(digest[1]), len(x), raw))
                else:
                    out.append((None,) * 4)
            cols = list(zip(*out)) if out else [[]] * 4
            made = [pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *made], names)

    out = rows.select(F.col("vec_id").cast("long"), "embedding", F.when(F.col("label").isNotNull(), F.xxhash64("label")).alias("label"))
    return out.mapInArrow(work, VECTORS)


def unit(raw: list[bytes], kind, width: int) -> np.ndarray:
    """Unit vectors in double precision, short ones padded with zeros."""
    out = np.zeros((len(raw), width))
    for i, r in enumerate(raw):
        x = np.frombuffer(r, kind)
        out[i, : len(x)] = x
    out /= np.abs(out).max(axis=1, keepdims=True)  # no overflow in the norm
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def learn(x: np.ndarray, mean: np.ndarray, rounds: int = 30, seed: int = 7):
    """Projections (PCA times a learned rotation), one after another, whose signs are the codes."""
    c = x - mean
    _, axes = np.linalg.eigh(c.T @ c)
    v = c @ axes
    rng = np.random.default_rng(seed)
    while True:
        r, _ = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))
        for _ in range(rounds):
            b = np.where(v @ r >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(b.T @ v)
            r = (left @ right).T
        yield axes @ r


def plan(n: int, width: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """Bits of a substring and least number of tables for n classes: what vectors without a common direction need."""
    bits = min(width, 30, max(4, round(math.log2(max(n, 2))) - 4))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log(1 - agree)))


def probes(x: np.ndarray, threshold: float, seed: int = 8) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs right at the threshold: a sampled vector turned towards another sampled one, and in any direction."""
    rng = np.random.default_rng(seed)
    a = x[rng.permutation(len(x))[:PROBES]]
    out = []
    for side in (x[rng.integers(0, len(x), len(a))], rng.standard_normal(a.shape)):
        side = side - (side * a).sum(1, keepdims=True) * a
        size = np.linalg.norm(side, axis=1)
        ok = size > 1e-6
        if ok.any():
            out.append((a[ok], threshold * a[ok] + math.sqrt(1 - threshold**2) * side[ok] / size[ok, None]))
    return out


class Codes:
    """Projections for as many tables as the probes need to meet.

    Centring widens the angles of vectors that share a direction, so tables are added until probes at the
    threshold meet. Where that takes more rows than tiles of all pairs would, one entry holds everything.
    """

    def __init__(self, sample: np.ndarray, n: int, threshold: float, crowd: int):
        self.bits, self.tables = plan(n, sample.shape[1], threshold)
        self.per = max(1, sample.shape[1] // self.bits)
        self.mean, self.maps = sample.mean(0), []
        most = max(self.tables, 4 * math.ceil(n / crowd))
        pairs = probes(sample, threshold)
        apart = [np.ones(len(x), bool) for x, _ in pairs]
        done = 0
        for m in learn(sample, self.mean):
            self.maps.append(m)
            for k, (x, y) in enumerate(pairs):
                p, q = self.pieces(x, m), self.pieces(y, m)
                apart[k] &= (p != q)[:, : max(0, self.tables - done)].all(1)
            done += self.per
            if done < self.tables:
                continue
            if all(a.mean() <= 2 * MISS for a in apart):  # twice: room for chance in the probes
                break
            if self.tables >= most:
                self.bits, self.tables, self.per, self.maps = 0, 1, 1, [m]
                break
            self.tables = min(most, done + self.per)
        apart = [np.bitwise_count(self.packed(x) ^ self.packed(y)).sum(1) for x, y in pairs] if self.bits else []
        #: Codes further apart than this aren't compared.
        self.within = int(max((np.quantile(d, 1 - FAR, method="higher") for d in apart), default=0)) if self.bits else 1 << 30

    def packed(self, x: np.ndarray) -> np.ndarray:
        """All bits of all tables, eight to a byte."""
        return np.packbits((self.substrings(x)[:, :, None] >> np.arange(self.bits) & 1).reshape(len(x), -1).astype(np.uint8), axis=1) if self.bits else np.zeros((len(x), 1), np.uint8)

    def unpacked(self, code: np.ndarray) -> np.ndarray:
        """Substrings from packed bits."""
        if not self.bits:
            return np.zeros((len(code), 1), np.int32)
        bit = np.unpackbits(code, axis=1)[:, : self.tables * self.bits].reshape(len(code), self.tables, self.bits)
        return (bit.astype(np.int32) << np.arange(self.bits, dtype=np.int32)).sum(2, dtype=np.int32)

    def pieces(self, x: np.ndarray, m: np.ndarray) -> np.ndarray:
        bit, power = (x - self.mean) @ m >= 0, 1 << np.arange(self.bits)
        return np.stack([bit[:, i * self.bits : (i + 1) * self.bits] @ power for i in range(self.per)], 1)

    def substrings(self, x: np.ndarray) -> np.ndarray:
        """A row per vector and a column per table."""
        return np.concatenate([self.pieces(x, m) for m in self.maps], 1)[:, : self.tables].astype(np.int32)


def near_vectors(rows: DataFrame, threshold: float = 0.93, crowd: int = CROWD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vec_id, embedding, label``.

    Only vectors of the same non-null label and the same dimension can link. A vector that is null, empty,
    zero, or has a null or non-finite component links with nothing: no links, its own component, kept.
    Rows that repeat a vec_id count as vectors of their own. An empty table gives an empty result.
    """
    spark = rows.sparkSession
    common.bounded_batches(spark)
    kind = np.float64 if "double" in rows.schema["embedding"].dataType.simpleString() else np.float32
    every = common.cut(vectors_of(rows), "vectors")
    classes = every.where("h1 is not null").groupBy("h1", "h2").agg(F.first("label").alias("label"), F.first("dim").alias("dim"), F.first("vec").alias("vec"), F.count("*").alias("weight"), F.min("vec_id").alias("first"))
    classes = common.cut(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    n, width = classes.agg(F.count("*"), F.max("dim")).first()
    if not n:
        return every.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    sample = [r["vec"] for r in classes.select("h1", "h2", "vec").orderBy(F.xxhash64("h1"), "h2").limit(SAMPLE).collect()]
    codes = Codes(unit([bytes(r) for r in sample], kind, width), n, threshold, crowd)
    shared = spark.sparkContext.broadcast(codes)  # a mean and a few square matrices of the dimension

    def coded(batches):
        for batch in batches:
            if batch.num_rows:
                x = unit(batch.column(3).to_pylist(), kind, width)
                sub, code = shared.value.substrings(x) if shared.value.bits else np.zeros((len(x), 1), np.int32), shared.value.packed(x)
                lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * sub.shape[1], pa.array(sub.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), lists, pa.array([r.tobytes() for r in code], pa.binary())], ["cid", "label", "dim", "sub", "code"])

    code = common.cut(classes.select("cid", "label", "dim", "vec").mapInArrow(coded, "cid long, label long, dim int, sub array<int>, code binary"), "codes")
    parts = common.shuffle_parts(spark)
    entries = code.select("cid", "label", "dim", "code", F.posexplode("sub").alias("t", "s")).select("cid", "code", "t", F.xxhash64("label", "dim", "t", "s").alias("key"))
    filled = entries.groupBy("key").agg(F.count("*").alias("count")).where("count > 1").select("key", F.ceil(F.col("count") / crowd).cast("int").alias("n"))
    filled = common.cut(filled, "entries")
    placed = entries.join(filled, "key")
    own = F.pmod(F.xxhash64("cid"), F.col("n")).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda j: F.struct((F.least(own, j) * F.col("n") + F.greatest(own, j)).alias("tile"), F.when(own == j, 2).when(own < j, 0).otherwise(1).cast("byte").alias("side")))
    placed = placed.select("key", "t", F.inline(tiles), "cid", "code")
    met = placed.repartition(parts, "key", "tile").sortWithinPartitions("key", "tile", "side", "cid")

    def candidates(batches):
        for table in common.runs(batches, ["key", "tile"], 4000):
            yield close_codes(table, shared.value)

    asked = common.cut(met.mapInArrow(candidates, "key long, tile int, t int, side byte, cid long"), "candidates")
    known = classes.select("cid", "vec", "weight").join(code.select("cid", "code"), "cid")
    fetched = asked.join(known, "cid").repartition(parts, "key", "tile").sortWithinPartitions("key", "tile", "side", "cid")

    def compare(batches):
        for table in common.runs(batches, ["key", "tile"], 4000):
            yield from compared(table, kind, width, threshold, shared.value)

    found = common.cut(fetched.mapInArrow(compare, "u long, v long, links long"), "links")
    for table in (code, filled, asked):
        common.drop_cut(table)
    comp = common.components(found.where("u <> v").select("u", "v"))
    least = comp.join(classes.select(F.col("cid").alias("node"), "first"), "node")
    least = common.cut(least, "members")
    lowest = least.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("n"))
    named = common.spread_join(least.select("node", "root"), lowest, ["root"], "n").select(F.col("node").alias("cid"), "component_id")
    links = found.groupBy(F.col("u").alias("cid")).agg(F.sum("links").alias("links"))
    by_class = classes.select("cid", "h1", "h2", "weight", "first").join(named, "cid", "left").join(links, "cid", "left")
    by_class = by_class.select("h1", "h2", F.col("weight").alias("size"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "first").alias("component_id"))
    linked = common.spread_join(every.where("h1 is not null").select("vec_id", "h1", "h2"), by_class, ["h1", "h2"], "size").select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id")
    alone = every.where("h1 is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def pairs_of(key: np.ndarray, tile: np.ndarray, side: np.ndarray, small: int = 24):
    """Row pairs of sorted tiles, some at a time: i before j, of the two sides or within a tile of one."""
    starts = common.key_starts([key, tile])
    ends = np.append(starts[1:], len(key))
    size = ends - starts
    few = (size > 1) & (size <= small)
    i, j = common.cross_segments(starts[few], size[few], starts[few], size[few])
    ok = (i < j) & ((side[i] == 2) | (side[i] != side[j]))
    i, j = i[ok], j[ok]
    for at in range(0, len(i), 1 << 16):
        yield i[at : at + (1 << 16)], j[at : at + (1 << 16)]
    for s, e in zip(starts[size > small], ends[size > small]):
        whole = side[s] == 2
        cut = e if whole else s + int((side[s:e] == 0).sum())
        step = max(1, (1 << 18) // (e - s))
        for at in range(s, cut, step):
            to = min(at + step, cut)
            lo = at if whole else cut
            p, q = np.repeat(np.arange(at, to), e - lo), np.tile(np.arange(lo, e), to - at)
            ok = p < q
            yield p[ok], q[ok]


def near_codes(code: np.ndarray, sub: np.ndarray, t: np.ndarray, i: np.ndarray, j: np.ndarray, codes: Codes) -> np.ndarray:
    """Which pairs are within the Hamming distance and meet in no earlier table."""
    ok = np.bitwise_count(code[i] ^ code[j]).sum(1, dtype=np.int32) <= codes.within
    k = np.flatnonzero(ok)
    earlier = (sub[i[k]] == sub[j[k]]) & (np.arange(sub.shape[1]) < t[i[k]][:, None])
    ok[k] = ~earlier.any(1)
    return ok


def codes_in(table: pa.Table, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    code = np.frombuffer(b"".join(table["code"].to_pylist()), np.uint8).reshape(table.num_rows, -1)
    return code, codes.unpacked(code)


def close_codes(table: pa.Table, codes: Codes) -> pa.RecordBatch:
    """Rows of tiles that have a candidate in their tile."""
    key, tile, t, side = (table[c].to_numpy() for c in ("key", "tile", "t", "side"))
    code, sub = codes_in(table, codes)
    stays = np.zeros(len(key), bool)
    for i, j in pairs_of(key, tile, side):
        ok = near_codes(code, sub, t, i, j, codes)
        stays[i[ok]] = stays[j[ok]] = True
    k = np.flatnonzero(stays)
    return pa.RecordBatch.from_arrays([pa.array(key[k]), pa.array(tile[k]), pa.array(t[k]), pa.array(side[k]), pa.array(table["cid"].to_numpy()[k])], ["key", "tile", "t", "side", "cid"])


def compared(table: pa.Table, kind, width: int, threshold: float, codes: Codes):
    """Links of whole tiles: each class's weight of partners in this table, and its local root."""
    key, tile, t, side, cid, weight = (table[c].to_numpy() for c in ("key", "tile", "t", "side", "cid", "weight"))
    x = unit(table["vec"].to_pylist(), kind, width)
    code, sub = codes_in(table, codes)
    links, a_all, b_all, held = np.zeros(len(cid), np.int64), [], [], 0
    for i, j in pairs_of(key, tile, side):
        ok = near_codes(code, sub, t, i, j, codes)
        i, j = i[ok], j[ok]
        hit = np.einsum("ij,ij->i", x[i], x[j]) >= threshold
        i, j = i[hit], j[hit]
        np.add.at(links, i, weight[j])
        np.add.at(links, j, weight[i])
        a_all.append(i)
        b_all.append(j)
        held += len(i)
        if held > 1 << 20:  # keep a forest of what there is
            lab = common.union_find(np.concatenate(a_all), np.concatenate(b_all), len(cid))
            r = np.flatnonzero(lab != np.arange(len(lab)))
            a_all, b_all, held = [r], [lab[r]], 0
    if not a_all or not sum(map(len, a_all)):
        return
    lab = common.union_find(np.concatenate(a_all), np.concatenate(b_all), len(cid))
    who = np.flatnonzero((links > 0) | (lab != np.arange(len(lab))))
    yield pa.RecordBatch.from_arrays([pa.array(cid[who]), pa.array(cid[lab[who]]), pa.array(links[who])], ["u", "v", "links"])


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.bounded_batches(spark)
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
