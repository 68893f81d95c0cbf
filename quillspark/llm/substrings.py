"""Exact substring dedup: bytes covered by a long string that also starts elsewhere.

Which strings may repeat is found without moving text. Every window of ``length`` bytes picks the ``GRAM``-byte
gram with the least hash in it (its anchor); windows in a row with one anchor form a run, and equal windows
always have equal anchors. Runs whose anchor no other run has go, in a shuffle of thin rows. The others fetch
their bytes. Equal runs are one, compared byte by byte, inside a batch first, so that a passage that a third of
all texts hold arrives as a row for each batch. The windows of an anchor's runs are suffixes to be sorted: prefix
polynomial hashes give the hash of any substring, binary search over them the common extension of two suffixes,
and so each comparison of a vectorised mergesort takes logarithmically many steps. Neighbours in that order with
a common extension of a whole window are compared byte by byte; where one fails, its group is compared by its
bytes alone. An anchor with more than ``CROWD`` runs is sorted in blocks; windows that several blocks hold are
found by hash, dealt out over as many groups as there are blocks, and compared byte by byte as well.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import common

LENGTH, GRAM = 400, 100
#: Bytes of text worked on at once; runs of one anchor that are sorted in one block.
BUFFER, CROWD = 1 << 21, 1024

_BASE = 0x9E3779B97F4A7C15 | 1
_LETTER = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int):
        if len(cls.up) < n:
            for name, factor in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                powers = np.full(n, factor, np.uint64)
                powers[0] = 1
                setattr(cls, name, np.cumprod(powers, dtype=np.uint64))
        return cls.up[:n], cls.down[:n]


class Hashes:
    """Prefix polynomial hashes of a byte buffer: the hash of any substring in constant time."""

    def __init__(self, raw: np.ndarray):
        up, self.down = Powers.of(len(raw) + 1)
        self.prefix = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_LETTER[raw] * up[:-1], out=self.prefix[1:])

    def of(self, start, length):
        return (self.prefix[start + length] - self.prefix[start]) * self.down[start]

    def grams(self, k: int) -> np.ndarray:
        n = len(self.prefix) - k
        return mixed((self.prefix[k:] - self.prefix[:n]) * self.down[:n])


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w neighbours, from prefix and suffix minima of blocks."""
    n = len(x) - w + 1
    pad = -len(x) % w
    blocks = np.concatenate((x, np.full(pad, np.iinfo(x.dtype).max, x.dtype))).reshape(-1, w)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[w - 1 : w - 1 + n])


def window_runs(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Runs (first window, last window, anchor position, anchor hash) inside the texts [starts, ends) of a buffer."""
    empty = np.zeros(0, np.int64)
    if len(raw) < length:
        return empty, empty, empty, np.zeros(0, np.uint64)
    low = np.uint64((1 << 24) - 1)
    h = Hashes(raw).grams(gram)
    best = sliding_min((h & ~low) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    anchor = (best & low).astype(np.int64)
    step = np.zeros(len(raw) + 1, np.int32)
    ok = ends - starts >= length
    np.add.at(step, starts[ok], 1)
    np.add.at(step, ends[ok] - length + 1, -1)
    valid = np.cumsum(step)[: len(anchor)] > 0
    new = np.ones(len(anchor), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    new[starts[ok]] = True
    first = np.flatnonzero(new & valid)
    stop = np.append(np.flatnonzero(new[1:] | ~valid[1:]) + 1, len(anchor))  # a run's windows end before the next stop
    last = stop[np.searchsorted(stop, first, side="right")] - 1
    return first, last, anchor[first], h[anchor[first]]


def buffers(texts, size: int = BUFFER, length: int = LENGTH):
    """(index, offset, part) lists of about ``size`` bytes; parts of one text overlap so that each window is in one."""
    held, n = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - length + 1), size):
            part = t[at : at + size + length - 1]
            held.append((i, at, part))
            n += len(part)
            if n >= size:
                yield held
                held, n = [], 0
    if held:
        yield held


THIN = "route long, uid long, start int, span int, anchor long, skip int, sure boolean"


def thin_runs(length: int, gram: int):
    """A row per run: where it spans, its anchor hash and place. Of runs with one anchor in a batch all are sure to
    stay; the first tells so to other batches, and the rest go anywhere.
    """

    def work(batches):
        for batch in batches:
            uid_all = batch.column(0).to_numpy()
            texts = [t.as_py().encode() for t in batch.column(1)]
            found = []
            for held in buffers(texts, BUFFER, length):
                raw = b"".join(p for _, _, p in held)
                size = np.array([len(p) for _, _, p in held])
                ends = np.cumsum(size)
                starts = ends - size
                first, last, at, h = window_runs(np.frombuffer(raw, np.uint8), starts, ends, length, gram)
                of = np.searchsorted(ends, first, side="right")
                doc = np.array([i for i, _, _ in held], np.int64)[of]
                place = first - starts[of] + np.array([o for _, o, _ in held], np.int64)[of]
                found.append((uid_all[doc], place, last - first + length, h.view(np.int64), at - first))
            if not found:
                continue
            uid, start, span, anchor, skip = (np.concatenate(v) for v in zip(*found))
            by = np.argsort(anchor, kind="stable")
            uid, start, span, anchor, skip = uid[by], start[by], span[by], anchor[by], skip[by]
            head = common.key_starts([anchor])
            size = np.diff(np.append(head, len(anchor)))
            several = np.repeat(size > 1, size)
            own = ~several
            own[head] = True
            route = np.where(own, anchor, mixed((uid ^ start).view(np.uint64)).view(np.int64))
            cols = [route, uid, start.astype(np.int32), span.astype(np.int32), anchor, skip.astype(np.int32), several]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["route", "uid", "start", "span", "anchor", "skip", "sure"])

    return work


def shared_only(batches):
    """Runs, sorted by route, that are sure or whose anchor several runs have."""
    for table in common.runs(batches, ["route"]):
        route, anchor, sure = (table[c].to_numpy() for c in ("route", "anchor", "sure"))
        by = np.lexsort((anchor, route))
        head = common.key_starts([route[by], anchor[by]])
        size = np.diff(np.append(head, len(by)))
        stays = (size > 1) | np.logical_or.reduceat(sure[by], head) if len(by) else size > 1
        keep = by[np.repeat(stays, size)]
        yield pa.RecordBatch.from_arrays([pa.array(table[c].to_numpy()[keep]) for c in ("uid", "start", "span", "anchor", "skip")], ["uid", "start", "span", "anchor", "skip"])


PIECES = "anchor long, uid long, start int, span int, skip int, h long, bytes binary"


def pieces(batches):
    """From ``uid, text, runs``: bytes of the runs. Of equal ones in the batch the first goes on; all of them repeat,
    which rows without an anchor say.
    """
    for batch in batches:
        seen: dict[tuple, list] = {}
        rows, whole = [], []
        for uid, text, runs in zip(*(batch.column(i) for i in range(3))):
            raw, uid = text.as_py().encode(), uid.as_py()
            for r in runs.as_py():
                part = raw[r["start"] : r["start"] + r["span"]]
                key = (r["anchor"], r["skip"], part)
                if key in seen:
                    whole.append((uid, r["start"], r["span"]))
                    if seen[key]:
                        whole.append(seen[key].pop())
                else:
                    seen[key] = [(uid, r["start"], r["span"])]
                    rows.append((r["anchor"], uid, r["start"], r["span"], r["skip"], xxhash.xxh3_64_intdigest(part) - (1 << 63), part))
        rows += [(None, uid, start, span, None, None, None) for uid, start, span in whole]
        cols = list(zip(*rows)) if rows else [[]] * 7
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)], ["anchor", "uid", "start", "span", "skip", "h", "bytes"])


def extension(h: Hashes, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common extension of suffixes a and b, up to ``most``, by binary search over prefix hashes."""
    lo, hi = np.zeros(len(a), np.int64), np.full(len(a), most, np.int64)
    same = h.of(a, most) == h.of(b, most)
    lo[same] = most
    open_ = np.flatnonzero(~same)
    hi[open_] -= 1
    while len(open_):
        mid = (lo[open_] + hi[open_] + 1) >> 1
        eq = h.of(a[open_], mid) == h.of(b[open_], mid)
        lo[open_[eq]] = mid[eq]
        hi[open_[~eq]] = mid[~eq] - 1
        open_ = open_[lo[open_] < hi[open_]]
    return lo


def suffix_sort(raw: np.ndarray, h: Hashes, suffix: np.ndarray, group: np.ndarray, most: int) -> np.ndarray:
    """Order of suffixes within groups of adjacent equal ``group``: bottom-up mergesort, all groups at once."""
    n = len(suffix)
    begin = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(begin, n))
    base, count = np.repeat(begin, size), np.repeat(size, size)
    order = np.arange(n)
    width = 1
    while width < size.max(initial=0):
        todo = np.flatnonzero(count > width)
        local = todo - base[todo]
        block = local // (2 * width) * (2 * width)
        left = (local // width) % 2 == 0
        lo = block + np.where(left, width, 0)
        hi = np.minimum(block + np.where(left, 2 * width, width), count[todo])
        lo = np.minimum(lo, hi)
        sibling = lo.copy()
        me = suffix[order[todo]]
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            x, y = suffix[order[base[todo[open_]] + mid]], me[open_]
            k = extension(h, x, y, most)
            whole = k == most
            at = np.where(whole, 0, k)
            less = np.where(whole, ~left[open_], raw[x + at] < raw[y + at])  # ties: the left run first
            lo[open_[less]] = mid[less] + 1
            hi[open_[~less]] = mid[~less]
            open_ = open_[lo[open_] < hi[open_]]
        to = base[todo] + block + (local - block) % width + (lo - sibling)
        moved = order.copy()
        moved[to] = order[todo]
        order = moved
        width *= 2
    return order


def repeated_windows(raw: bytes, start: np.ndarray, span: np.ndarray, skip: np.ndarray, group: np.ndarray, length: int):
    """Windows of runs (adjacent equal ``group``: one anchor) as (run, first byte, repeats in its group, hash)."""
    buf = np.frombuffer(raw, np.uint8)
    h = Hashes(buf)
    n = span - length + 1
    run = np.repeat(np.arange(len(n)), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    before = skip[run] - place  # equal windows have their anchor at the same place
    key = np.lexsort((before, group[run]))
    run, place = run[key], place[key]
    gid = np.cumsum(np.append(True, (group[run][1:] != group[run][:-1]) | (before[key][1:] != before[key][:-1]))) - 1
    suffix = start[run] + place
    order = suffix_sort(buf, h, suffix, gid, length)
    s, g = suffix[order], gid[order]
    twin = np.flatnonzero((g[1:] == g[:-1]) & (h.of(s[1:], length) == h.of(s[:-1], length))) if len(s) else np.zeros(0, np.int64)
    hit, false = np.zeros(len(s), bool), []
    offsets = np.arange(length)
    for at in range(0, len(twin), 8192):
        t = twin[at : at + 8192]
        same = (buf[s[t][:, None] + offsets] == buf[s[t + 1][:, None] + offsets]).all(1)
        false.append(g[t[~same]])
        t = t[same]
        hit[t] = hit[t + 1] = True
    for bad in np.unique(np.concatenate(false)) if false else []:  # equal hashes of different bytes: neither order nor hash counts
        mine = np.flatnonzero(g == bad)
        windows = [raw[x : x + length] for x in s[mine].tolist()]
        count = Counter(windows)
        hit[mine] = [count[w] > 1 for w in windows]
    out = np.zeros(len(s), bool)
    out[order] = hit
    return run, place, out, h.of(suffix, length)


def ranges(place: np.ndarray, length: int) -> bytes:
    """Byte ranges (from, to) covered by windows at sorted places, as 32-bit pairs."""
    cut = np.flatnonzero(np.diff(place) > length)
    a, b = place[np.append(0, cut + 1)], place[np.append(cut, len(place) - 1)] + length
    return np.stack((a, b), 1).astype("<i4").tobytes()


MARKS = "uid long, start int, span int, covered binary"
JUDGED = MARKS + ", anchor long, bucket int, block int, hashes binary, refs binary, owners binary"
SAME = "uid long, start int, a int, b int, uid2 long, start2 int, a2 int, anchor long"


def sort_blocks(length: int):
    """Marks of the runs in a block; for a crowded anchor also its windows by bucket.

    A mark without ``covered`` means the whole run. Equal runs are one for the sort.
    """

    def work(batches):
        for table in common.runs(batches, ["anchor", "block"], 2500):
            anchor, block, n, uid, start, skip, h = (table[c].to_numpy() for c in ("anchor", "block", "n", "uid", "start", "skip", "h"))
            text = table["bytes"].to_pylist()
            heads, rows, last = [], [], {}
            for i in range(len(text)):  # sorted by anchor, block and hash
                key = (anchor[i], block[i], h[i], skip[i], text[i])
                if key in last:
                    j, told = last[key]
                    rows += [(int(uid[k]), int(start[k]), len(text[k])) + (None,) * 7 for k in ([i] if told else [j, i])]
                    last[key] = (j, True)
                else:
                    last = last if heads and (anchor[heads[-1]], block[heads[-1]]) == key[:2] else {}
                    last[key] = (i, False)
                    heads.append(i)
            k = np.array(heads, np.int64)
            anchor, block, n, uid, start, skip = anchor[k], block[k], n[k], uid[k], start[k], skip[k]
            text = [text[i] for i in heads]
            span = np.array(list(map(len, text)), np.int64)
            group = np.cumsum(np.append(True, (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1]))) - 1
            run, place, hit, wh = repeated_windows(b"".join(text), np.cumsum(span) - span, span, skip.astype(np.int64), group, length)
            by = np.lexsort((place[hit], run[hit]))
            r, p = run[hit][by], place[hit][by]
            for k in np.split(np.arange(len(r)), np.flatnonzero(np.diff(r)) + 1) if len(r) else []:
                i = r[k[0]]
                rows.append((int(uid[i]), int(start[i]), int(span[i]), ranges(p[k], length)) + (None,) * 6)
            crowded = n[run] > 1
            if crowded.any():
                wh = mixed(wh ^ (mixed((skip[run] - place + 7).astype(np.uint64))))
                # each block speaks for every window of its own once, repeated there or not
                run, place, wh, hit = run[crowded], place[crowded], wh[crowded], hit[crowded]
                for g in np.unique(group[run]):
                    m = group[run] == g
                    mh, mr, mp, mt = wh[m], run[m], place[m], hit[m]
                    first = int(mr.min())
                    bucket = (mh >> np.uint64(33)).astype(np.int64) % int(n[first])
                    member = np.flatnonzero(group == g)
                    owners = np.stack((uid[member], start[member].astype(np.int64)), 1).tobytes()
                    for b in np.unique(bucket):
                        k = np.flatnonzero(bucket == b)
                        keep = np.union1d(k[np.unique(mh[k], return_index=True)[1]], k[~mt[k]])
                        refs = np.stack((mr[keep] - member[0], mp[keep]), 1).astype("<i4").tobytes()
                        rows.append((None, None, None, None, int(anchor[first]), int(b), int(block[first]), mh[keep].tobytes(), refs, owners))
            cols = list(zip(*rows)) if rows else [[]] * 10
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)], [x.split()[0] for x in JUDGED.split(", ")])

    return work


def merge_blocks(length: int):
    """Windows that several blocks of an anchor hold by their hashes, as ranges of bytes [a, b) of a run that should be
    those of another run from a2 on; to be compared.
    """

    def work(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
        refs = [np.frombuffer(x, "<i4").reshape(-1, 2) for x in table["refs"].to_pylist()]
        owners = [np.frombuffer(x, np.int64).reshape(-1, 2) for x in table["owners"].to_pylist()]
        base = np.cumsum([0] + [len(o) for o in owners])
        h = np.concatenate(parts)
        run = np.concatenate([r[:, 0] + base[i] for i, r in enumerate(refs)])
        place = np.concatenate([r[:, 1] for r in refs]).astype(np.int64)
        owner = np.concatenate(owners)
        by = np.lexsort((place, run, h))
        h, run, place = h[by], run[by], place[by]
        head = common.key_starts([h])
        head = np.repeat(head, np.diff(np.append(head, len(h))))
        other = np.flatnonzero(head != np.arange(len(h)))
        r, p, r2, p2 = run[other], place[other], run[head[other]], place[head[other]]
        by = np.lexsort((p, p2 - p, r2, r))
        r, p, r2, p2 = r[by], p[by], r2[by], p2[by]
        new = np.ones(len(r), bool)
        new[1:] = (r[1:] != r[:-1]) | (r2[1:] != r2[:-1]) | (np.diff(p2 - p) != 0) | (np.diff(p) > length)
        s = np.flatnonzero(new)
        e = np.append(s[1:], len(r)) - 1 if len(r) else s
        x, y = owner[r[s]], owner[r2[s]]
        cols = [x[:, 0], x[:, 1].astype(np.int32), p[s].astype(np.int32), (p[e] + length).astype(np.int32), y[:, 0], y[:, 1].astype(np.int32), p2[s].astype(np.int32), np.full(len(s), table["anchor"][0].as_py(), np.int64)]
        return pa.table([pa.array(np.ascontiguousarray(c)) for c in cols], [x.split()[0] for x in SAME.split(", ")])

    return work


def covered(a: str, b: str):
    """A range of bytes as ``ranges`` writes it."""
    def little(c: str):
        big = F.lpad(F.hex(F.col(c).cast("long")), 8, "0")
        return F.unhex(F.concat(*[F.substring(big, k, 2) for k in (7, 5, 3, 1)]))

    return F.concat(little(a), little(b))


def across_blocks(judged: DataFrame, held: DataFrame, length: int) -> DataFrame:
    """Marks of windows in several blocks of an anchor whose bytes are the same.

    A range that isn't the same is taken apart: each of its windows is compared with the one it should be, and
    those that differ are grouped by their bytes.
    """
    same = judged.where("bucket is not null").groupBy("anchor", "bucket").applyInArrow(merge_blocks(length), SAME)
    own = held.select("anchor", "uid", "start", "span", "bytes")
    other = held.select("anchor", F.col("uid").alias("uid2"), F.col("start").alias("start2"), F.col("span").alias("span2"), F.col("bytes").alias("bytes2"))
    met = same.join(own, ["anchor", "uid", "start"]).join(other, ["anchor", "uid2", "start2"])
    cut_out = lambda raw, at, n: F.substring(F.col(raw), F.col(at) + 1, n)
    n = F.col("b") - F.col("a")
    met = common.cut(met.withColumn("b2", F.col("a2") + n).withColumn("equal", cut_out("bytes", "a", n) == cut_out("bytes2", "a2", n)), "across")
    good = met.where("equal")
    marks = good.select("uid", "start", "span", covered("a", "b").alias("covered")).unionByName(good.select(F.col("uid2").alias("uid"), F.col("start2").alias("start"), F.col("span2").alias("span"), covered("a2", "b2").alias("covered")))
    bad = met.where("not equal")
    if not bad.limit(1).count():
        return marks
    apart = bad.withColumn("k", F.explode(F.sequence(F.lit(0), n - length)))
    window = lambda raw, at: F.substring(F.col(raw), F.col(at) + F.col("k") + 1, F.lit(length))
    both = apart.select("anchor", "uid", "start", "span", (F.col("a") + F.col("k")).alias("a"), window("bytes", "a").alias("w")).unionByName(
        apart.select("anchor", F.col("uid2").alias("uid"), F.col("start2").alias("start"), F.col("span2").alias("span"), (F.col("a2") + F.col("k")).alias("a"), window("bytes2", "a2").alias("w"))
    ).distinct()
    many = both.groupBy("anchor", "w").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "w")
    again = both.join(many, ["anchor", "w"]).withColumn("b", F.col("a") + length)
    return marks.unionByName(again.select("uid", "start", "span", covered("a", "b").alias("covered")))


def dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` of every text as UTF-8 bytes.

    Removes each byte covered by a string of ``length`` bytes that starts anywhere else, same text
    included (overlaps count), judged on the input; no string crosses texts. Null text is empty. Rows
    that repeat a doc_id are texts of their own; a row that repeats id and text repeats all its strings.
    ``kept`` is the remaining text as bytes. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    common.bounded_batches(spark)
    parts = common.shuffle_parts(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"))
    base = base.withColumn("uid", F.xxhash64("doc_id", "text"))
    texts = base.where(F.octet_length("text") >= length).select("uid", "text")
    thin = texts.mapInArrow(thin_runs(length, gram), THIN).repartition(parts, "route").sortWithinPartitions("route")
    asked = thin.mapInArrow(shared_only, "uid long, start int, span int, anchor long, skip int")
    asked = asked.groupBy("uid").agg(F.collect_list(F.struct("start", "span", "anchor", "skip")).alias("runs"))  # a text's own runs
    single = texts.dropDuplicates(["uid"]) if docs_repeat(base) else texts
    held = common.cut(single.join(asked, "uid").select("uid", "text", "runs").mapInArrow(pieces, PIECES), "pieces")
    with_bytes = held.where("anchor is not null")
    crowded = common.cut(with_bytes.groupBy("anchor").agg(F.count("*").alias("runs")).where(F.col("runs") > crowd).select("anchor", F.ceil(F.col("runs") / crowd).cast("int").alias("n")), "crowded")
    blocks = with_bytes.join(common.small(crowded), "anchor", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    blocks = blocks.withColumn("block", F.pmod("h", "n").cast("int")).repartition(parts, "anchor", "block").sortWithinPartitions("anchor", "block", "h")
    judged = common.cut(blocks.mapInArrow(sort_blocks(length), JUDGED), "judged")
    marks = held.where("anchor is null").select("uid", "start", "span", F.lit(None).cast("binary").alias("covered")).unionByName(judged.where("bucket is null").select("uid", "start", "span", "covered"))
    if crowded.limit(1).count():
        marks = marks.unionByName(across_blocks(judged, with_bytes.join(common.small(crowded).drop("n"), "anchor", "left_semi"), length))
    marks = marks.groupBy("uid").agg(F.collect_list(F.struct("start", "span", "covered")).alias("marks"))  # a text's own marks
    rows = base.join(marks, "uid", "left").select("doc_id", "text", "marks")
    return rows.mapInArrow(apply_marks, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def docs_repeat(base: DataFrame) -> bool:
    """Whether any id and text comes twice."""
    return bool(base.groupBy("uid").count().where("count > 1").limit(1).count())


def apply_marks(batches):
    for batch in batches:
        out = []
        for text, marks in zip(batch.column(1), batch.column(2)):
            raw = text.as_py().encode()
            n, removed, spans, kept = len(raw), 0, 0, raw
            marks = marks.as_py()
            if marks:
                step = np.zeros(n + 1, np.int32)
                for m in marks:
                    if m["covered"] is None:
                        step[m["start"]] += 1
                        step[m["start"] + m["span"]] -= 1
                    else:
                        a, b = np.frombuffer(m["covered"], "<i4").reshape(-1, 2).T + m["start"]
                        np.add.at(step, a, 1)
                        np.add.at(step, b, -1)
                gone = np.cumsum(step[:-1]) > 0
                removed = int(gone.sum())
                spans = int((gone & ~np.append(False, gone[:-1])).sum())
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
            out.append((n, removed, spans, hashlib.sha256(kept).hexdigest(), kept))
        cols = list(zip(*out)) if out else [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(list(c), t) for c, t in zip(cols, kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(common.documents(spark, sf_dir)).drop("kept")
