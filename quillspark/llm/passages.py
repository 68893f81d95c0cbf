"""Near-duplicate passages by compact windows.

A text's tokens are hashed shingles of five words. For each of ``HASHES`` min-hash functions, the Cartesian
tree of a text over the function's values has one compact window (l, c, r) per node: every subsequence that
holds token c and stays inside l to r has that token as its min-hash. Only windows of at least the least
passage's tokens matter; sliding minima find their tokens, about two for every such length and function, and
the nearest smaller tokens, which are nodes of that kind themselves, bound them.

Windows with one function and token form a signature's group. A passage of exactly the least length that two
texts share has its minimum in a group with both, whatever the function; at similarity s a function finds it
with chance s, and one of the functions is enough, because links are verified on tokens. Signatures of one
text only go, in a shuffle of thin rows. Each window of the others carries the tokens around c inside its
interval. Equal ones are one class, found inside a batch first, so that a signature that a third of all texts
hold arrives as a row for each batch. The classes of a group meet pair by pair, those of a crowded group in
tiles: the interval where both windows overlap must hold a stretch of the least length around c in which
enough tokens of one are in the other at about the same place. What comes out is linear in the rows: a forest
of the links, and for each window the partners that reach furthest to the left and to the right.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import common
from quillspark.llm.substrings import BUFFER, Hashes, mixed, sliding_min

SHINGLE, SIMILARITY = 5, 0.8
#: Words of the shortest passage, and hash functions.
LEAST_WORDS, HASHES = 50, 3
#: Places by which a token may have moved, and tokens in place from which a pair is looked at.
MOVED, ALIGNED = 3, 12
#: Windows of one signature that a tile holds at most.
CROWD = 4096

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MIX = np.random.default_rng(9).integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOW = np.uint64((1 << 24) - 1)
_PLACE = 1 << 28


def tokens(raw: bytes, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word (ASCII lower case) with the words after it, and the byte where each word starts."""
    buf = np.frombuffer(raw.lower(), np.uint8)
    gap = _SPACE[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), start
    h = mixed(Hashes(buf).of(start, end - start) ^ (end - start).astype(np.uint64))
    out = np.zeros(len(h), np.uint64)
    for j in range(shingle):
        out[: len(h) - j] += h[j:] * _MIX[j]
    return mixed(out), start


def value(x: np.ndarray, k: int) -> np.ndarray:
    """Values of hash function k, different for each place of a buffer (which has less than 2^24 tokens)."""
    return (mixed(x ^ _MIX[8 + k]) & ~_LOW) | np.arange(len(x), dtype=np.uint64)


def windows(x: np.ndarray, first: np.ndarray, last: np.ndarray, width: int, hashes: int):
    """(hash function, position) of every minimum of ``width`` tokens inside the texts [first, last)."""
    if len(x) < width:
        return np.zeros(0, np.int8), np.zeros(0, np.int64)
    step = np.zeros(len(x) + 1, np.int32)
    ok = last - first >= width
    np.add.at(step, first[ok], 1)
    np.add.at(step, last[ok] - width + 1, -1)
    valid = np.cumsum(step)[: len(x) - width + 1] > 0
    kinds, places = [], []
    for k in range(hashes):
        best = sliding_min(value(x, k), width)[valid]
        c = (best & _LOW).astype(np.int64)  # never moves back
        c = c[np.flatnonzero(np.append(True, c[1:] != c[:-1]))] if len(c) else c
        kinds.append(np.full(len(c), k, np.int8))
        places.append(c)
    return np.concatenate(kinds), np.concatenate(places)


def intervals(x: np.ndarray, first: np.ndarray, last: np.ndarray, kind: np.ndarray, place: np.ndarray):
    """l and r (inclusive) of the compact windows that ``windows`` finds: up to the nearest smaller tokens.

    A nearest smaller token has a window of its own that holds this one, so it is among the places given.
    """
    left, right = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    text = np.searchsorted(last, place, side="right")
    for k in np.unique(kind):
        at = np.flatnonzero(kind == k)
        p, t = place[at], text[at]
        v = value(x, int(k))[p]
        for out, step in ((left, -1), (right, 1)):
            near = np.arange(len(p)) + step
            moving = np.arange(len(p))
            while len(moving):
                at_ = near[moving]
                moving, at_ = (z[(at_ >= 0) & (at_ < len(p))] for z in (moving, at_))
                larger = (t[at_] == t[moving]) & (v[at_] > v[moving])
                moving = moving[larger]
                near[moving] = near[at_[larger]]
            inside = (near >= 0) & (near < len(p))
            inside[inside] = t[near[inside]] == t[inside]
            edge = first[t] if step < 0 else last[t] - 1
            out[at] = np.where(inside, p[np.where(inside, near, 0)] - step, edge)
    return left, right


def parts(texts: list[bytes], size: int = BUFFER):
    """Index lists of texts with about ``size`` bytes together."""
    part, n = [], 0
    for i, t in enumerate(texts):
        part.append(i)
        n += len(t)
        if n >= size:
            yield part
            part, n = [], 0
    if part:
        yield part


class Buffer:
    """Tokens of several texts one after another; the last shingles of a text, which reach into the next, don't count."""

    def __init__(self, texts: list[bytes], part: list[int]):
        end = np.cumsum([len(texts[i]) + 1 for i in part])
        self.x, start = tokens(b"\n".join(texts[i] for i in part))
        last = np.searchsorted(start, end)
        self.first = np.append(0, last[:-1])
        self.ends = last
        self.last = np.maximum(last - SHINGLE + 1, self.first)
        self.part = np.array(part, np.int64)

    def windows(self, width: int, hashes: int):
        """Function, position and text (index into the part) of each window."""
        k, c = windows(self.x, self.first, self.last, width, hashes)
        return k, c, np.searchsorted(self.ends, c, side="right")


def signatures(x: np.ndarray, kind: np.ndarray) -> np.ndarray:
    return mixed(x ^ _MIX[kind.astype(np.int64)]).view(np.int64)


THIN = "route long, key long, uid long, at int, sure boolean"


def thin_windows(width: int, hashes: int):
    """Signatures for the shuffle. Where several texts of a batch have one, all its rows are sure to stay; the
    first tells so to other batches, and the rest go anywhere.
    """

    def work(batches):
        for batch in batches:
            uid_all, texts = batch.column(0).to_numpy(), [t.as_py().encode() for t in batch.column(1)]
            keys, uids, ats = [], [], []
            for part in parts(texts):
                b = Buffer(texts, part)
                k, c, doc = b.windows(width, hashes)
                keys.append(signatures(b.x[c], k))
                uids.append(uid_all[b.part[doc]])
                ats.append((k.astype(np.int64) * _PLACE + c - b.first[doc]).astype(np.int32))
            if not keys:
                continue
            key, uid, at = np.concatenate(keys), np.concatenate(uids), np.concatenate(ats)
            by = np.lexsort((at, uid, key))
            key, uid, at = key[by], uid[by], at[by]
            start = common.key_starts([key])
            size = np.diff(np.append(start, len(key)))
            several = np.repeat(uid[start] != uid[start + size - 1], size)
            own = ~several
            own[start] = True
            route = np.where(own, key, mixed((uid ^ at).view(np.uint64)).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (route, key, uid, at, several)], ["route", "key", "uid", "at", "sure"])

    return work


def shared_only(batches):
    """``uid, at`` of rows, sorted by route, that are sure or whose signature several texts have."""
    for table in common.runs(batches, ["route"]):
        route, key, uid, sure = (table[c].to_numpy() for c in ("route", "key", "uid", "sure"))
        by = np.lexsort((uid, key, route))
        start = common.key_starts([route[by], key[by]])
        size = np.diff(np.append(start, len(by)))
        stays = (uid[by][start] != uid[by][start + size - 1]) | np.logical_or.reduceat(sure[by], start) if len(by) else np.zeros(0, bool)
        keep = by[np.repeat(stays, size)]
        yield pa.RecordBatch.from_arrays([pa.array(uid[keep]), pa.array(table["at"].to_numpy()[keep])], ["uid", "at"])


HOLDERS = "key long, uid long, places array<int>, span long, around binary, other long, `from` int, `to` int"
NAMES = ["key", "uid", "places", "span", "around", "other", "from", "to"]


def binary(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def around(x: np.ndarray, c: np.ndarray, left: np.ndarray, right: np.ndarray, reach: int) -> np.ndarray:
    """16 bits of each token from ``reach`` before c to as many after it, zero outside the window."""
    at = c[:, None] + np.arange(-reach, reach + 1)
    inside = (at >= left[:, None]) & (at <= right[:, None])
    short = np.maximum((x >> np.uint64(48)).astype(np.uint16), 1)
    return np.where(inside, short[np.where(inside, at, 0)], np.uint16(0))


def span_of(rows: np.ndarray) -> np.ndarray:
    """A hash of each row."""
    weight = mixed(np.arange(1, rows.shape[1] + 1, dtype=np.uint64) * _MIX[0]) | np.uint64(1)
    return mixed((rows.astype(np.uint64) * weight).sum(1, dtype=np.uint64)).view(np.int64)


def same_rows(keys: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """Whether a row has the keys and the tokens of the row before it."""
    same = np.zeros(len(rows), bool)
    if len(rows):
        same[1:] = (rows[1:] == rows[:-1]).all(1)
        for k in keys:
            same[1:] &= k[1:] == k[:-1]
    return same


class Places:
    """Places of rows: a list for each."""

    def __init__(self, values: np.ndarray, offsets: np.ndarray):
        self.values, self.offsets = values, np.asarray(offsets, np.int64)

    @classmethod
    def read(cls, column: pa.ChunkedArray) -> "Places":
        lists = column.combine_chunks()
        return cls(lists.flatten().to_numpy(), np.append(0, np.cumsum(np.asarray(lists.value_lengths()))))

    def of(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of places of each row i, and the places."""
        n = self.offsets[i + 1] - self.offsets[i] if len(i) else np.zeros(0, np.int64)
        at = np.repeat(self.offsets[i] if len(i) else n, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return n, self.values[at]

    def lists(self, i: np.ndarray) -> pa.Array:
        n, values = self.of(i)
        return pa.ListArray.from_arrays(np.append(0, np.cumsum(n)).astype(np.int32), pa.array(values.astype(np.int32)))

    def take(self, i: np.ndarray) -> "Places":
        n, values = self.of(i)
        return Places(values, np.append(0, np.cumsum(n)))


def classes_in(key: np.ndarray, span: np.ndarray, uid: np.ndarray, rows: np.ndarray):
    """For rows sorted by key, span and text: the first row of each row's class (equal tokens), and the first row
    of another text in it (-1 if there is none).
    """
    n = len(key)
    start = np.flatnonzero(~same_rows([key, span], rows))
    size = np.diff(np.append(start, n))
    head = np.repeat(start, size)
    differs = uid != uid[head]
    second = np.minimum.reduceat(np.where(differs, np.arange(n), n), start) if n else start
    second = np.repeat(np.where(second < n, second, -1), size)
    return head, second


def holders(width: int, hashes: int):
    """From ``uid, text, ats``: rows of the windows asked for, and links to the first of equal ones in the batch."""
    reach = width - 1

    def work(batches):
        for batch in batches:
            uid_all, texts = batch.column(0).to_numpy(), [t.as_py().encode() for t in batch.column(1)]
            asked = batch.column(2).to_pylist()
            found = []
            for part in parts(texts):
                b = Buffer(texts, part)
                k, c, doc = b.windows(width, hashes)
                left, right = intervals(b.x, b.first, b.last, k, c)
                at = k.astype(np.int64) * _PLACE + c - b.first[doc]
                wanted = np.concatenate([np.array(asked[i], np.int64) for i in part])
                owner = np.repeat(np.arange(len(part)), [len(asked[i]) for i in part])
                mine = np.isin(doc * (16 * _PLACE) + at, owner * (16 * _PLACE) + wanted)
                k, c, doc, left, right = k[mine], c[mine], doc[mine], left[mine], right[mine]
                found.append((signatures(b.x[c], k), uid_all[b.part[doc]], (c - b.first[doc]).astype(np.int32), around(b.x, c, left, right, reach)))
            if not found:
                continue
            key, uid, c, rows = (np.concatenate(v) for v in zip(*found))
            span = span_of(rows)
            by = np.lexsort((c, uid, span, key))
            key, uid, c, rows, span = key[by], uid[by], c[by], rows[by], span[by]
            own = same_rows([key, span, uid], rows)  # a text that repeats itself has many equal windows
            first = np.flatnonzero(~own)
            places = Places(c, np.append(first, len(c)))
            key, uid, rows, span = key[first], uid[first], rows[first], span[first]
            head, second = classes_in(key, span, uid, rows)
            me = np.arange(len(key))
            linked = uid != uid[head]
            kept = np.flatnonzero(~linked | (second == me))
            yield pa.RecordBatch.from_arrays([pa.array(key[kept]), pa.array(uid[kept]), places.lists(kept), pa.array(span[kept]), binary(rows[kept]), pa.nulls(len(kept), pa.int64()), pa.nulls(len(kept), pa.int32()), pa.nulls(len(kept), pa.int32())], NAMES)
            i = np.flatnonzero(linked | (second >= 0))  # the first text's row has a partner in the second
            yield link_rows(uid, places, rows, i, np.where(linked[i], head[i], second[i]), *whole(rows, i))

    return work


def whole(rows: np.ndarray, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last column (exclusive) inside the windows of rows i."""
    inside = rows[i] > 0
    return inside.argmax(1) if len(i) else i, rows.shape[1] - inside[:, ::-1].argmax(1) if len(i) else i


def link_rows(uid, places, rows, i, j, lo, hi):
    """Links of rows i to rows j over columns lo to hi, as the text's words from and to; at the places of a row that lie
    close together the words are one run.
    """
    reach = rows.shape[1] // 2
    n, c = places.of(i)
    k = np.repeat(np.arange(len(i)), n)
    new = np.ones(len(c), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] - c[:-1] > (hi - lo)[k[1:]])
    start = np.flatnonzero(new)
    last = np.append(start[1:], len(c)) - 1 if len(c) else start
    k = k[start]
    empty = len(k)
    columns = [pa.nulls(empty, pa.int64()), pa.array(uid[i][k]), pa.nulls(empty, pa.list_(pa.int32())), pa.nulls(empty, pa.int64()), pa.nulls(empty, pa.binary()), pa.array(uid[j][k])]
    return pa.RecordBatch.from_arrays(columns + [pa.array((c[start] + lo[k] - reach).astype(np.int32)), pa.array((c[last] + hi[k] - reach + SHINGLE - 1).astype(np.int32))], NAMES)


def stretches(a: np.ndarray, b: np.ndarray, width: int, need: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each pair of rows: whether a stretch of ``width`` around the middle has ``need`` tokens of a in b, at most
    ``MOVED`` places away, and the first and last column (exclusive) of what such stretches cover.
    """
    inside = (a > 0) & (b > 0)
    hit = a == b
    for s in range(1, MOVED + 1):
        hit[:, s:] |= a[:, s:] == b[:, :-s]
        hit[:, :-s] |= a[:, :-s] == b[:, s:]
    hit &= inside
    total = np.zeros((len(a), hit.shape[1] + 1), np.int16)
    np.cumsum(hit, axis=1, out=total[:, 1:])
    good = total[:, width:] - total[:, :-width] >= need
    ok = good.any(1)
    lo, hi = good.argmax(1), good.shape[1] - good[:, ::-1].argmax(1) - 1 + width
    column = np.arange(hit.shape[1])
    covered = hit & (column >= lo[:, None]) & (column < hi[:, None])
    return ok, covered.argmax(1), hit.shape[1] - covered[:, ::-1].argmax(1)


class Reaches:
    """For each row the partners that reach furthest to either side, and a forest of all links."""

    def __init__(self, n: int, middle: int):
        self.lo, self.hi = np.full(n, middle, np.int32), np.full(n, middle, np.int32)
        self.by_lo, self.by_hi = np.full(n, -1), np.full(n, -1)
        self.root = np.arange(n)
        self.links: list[tuple] = []

    def add(self, i, j, lo, hi) -> None:
        for p, q in ((i, j), (j, i)):
            order = np.lexsort((lo, p))
            r = order[common.key_starts([p[order]])]
            better = lo[r] < self.lo[p[r]]
            self.lo[p[r][better]], self.by_lo[p[r][better]] = lo[r][better], q[r][better]
            order = np.lexsort((-hi, p))
            r = order[common.key_starts([p[order]])]
            better = hi[r] > self.hi[p[r]]
            self.hi[p[r][better]], self.by_hi[p[r][better]] = hi[r][better], q[r][better]
        self.join(i, j)

    def join(self, i, j) -> None:
        """Trees of the rows i and j become one; the links that do it are kept."""
        a, b = self.root[i], self.root[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        tree, where = np.unique(np.concatenate((a, b)), return_inverse=True)
        x, y = where[: len(a)], where[len(a) :]
        lab = common.union_find(x, y, len(tree))
        lo, hi = min(i.min(), j.min(), tree[0]), max(i.max(), j.max(), tree[-1]) + 1
        known = np.isin(self.root[lo:hi], tree)
        part = self.root[lo:hi]
        part[known] = tree[lab[np.searchsorted(tree, part[known])]]
        whole, first = np.unique(np.minimum(x, y) * np.int64(len(tree)) + np.maximum(x, y), return_index=True)
        for k in first[spanning(whole, len(tree))]:
            self.links.append((i[k], j[k]))


def spanning(pairs: np.ndarray, n: int) -> np.ndarray:
    """Of links x * n + y between n trees those that a forest needs."""
    up = list(range(n))

    def find(z):
        while up[z] != z:
            up[z] = up[up[z]]
            z = up[z]
        return z

    out = []
    for k, pair in enumerate(pairs.tolist()):
        x, y = find(pair // n), find(pair % n)
        if x != y:
            up[y] = x
            out.append(k)
    return np.array(out, np.int64)


def equal_stretches(rows: np.ndarray, uid: np.ndarray, width: int):
    """(row, partner, first column, last column exclusive) of stretches of ``width`` tokens that other texts' rows have
    at the same place: every row of a class of equal stretches with the class's first row of another text.
    """
    n, reach = len(rows), rows.shape[1] - width + 1
    up = np.cumprod(np.append(np.uint64(1), np.full(rows.shape[1] - 1, _MIX[1])), dtype=np.uint64)
    total, gaps = np.zeros((n, rows.shape[1] + 1), np.uint64), np.zeros((n, rows.shape[1] + 1), np.int16)
    np.cumsum(mixed(rows.astype(np.uint64)) * up, axis=1, out=total[:, 1:])
    np.cumsum(rows == 0, axis=1, out=gaps[:, 1:])
    row, at = np.nonzero(gaps[:, width:] == gaps[:, :-width])
    h = mixed((total[row, at + width] - total[row, at]) ^ (at.astype(np.uint64) * _MIX[2]))
    # the sums differ by the power of their place, which is the same for equal places
    by = np.lexsort((row, h))
    h, row, at = h[by], row[by], at[by]
    start = common.key_starts([h])
    size = np.diff(np.append(start, len(h)))
    head = np.repeat(start, size)
    differs = uid[row] != uid[row[head]]
    second = np.minimum.reduceat(np.where(differs, np.arange(len(h)), len(h)), start) if len(h) else start
    second = np.repeat(second, size)
    partner = np.where(differs, head, second)
    ok = partner < len(h)
    row, at, partner = row[ok], at[ok], row[partner[ok]]
    by = np.lexsort((at, partner, row))
    row, at, partner = row[by], at[by], partner[by]
    start = common.key_starts([row, partner])
    last = np.append(start[1:], len(row)) - 1
    return row[start], partner[start], at[start], at[last] + width if len(row) else at[start]


def rare_tokens(rows: np.ndarray, width: int, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and tokens (as codes) by which rows may meet.

    Two stretches with ``need`` of ``width`` tokens in common share one of the ``width - need + 1`` tokens of either
    that are rarest in the group (``MOVED`` more, as a stretch's tokens may lie that far outside the other's); tokens
    outside a window are rarer than any and meet nothing.
    """
    token, code, n = np.unique(rows, return_inverse=True, return_counts=True)
    code = code.reshape(rows.shape)
    rarity = np.empty(len(token), np.int32)
    rarity[np.lexsort((token, np.where(token == 0, 0, n)))] = np.arange(len(token))
    rank = rarity[code]
    asked = np.zeros(rows.shape, bool)
    k = min(width - 1, width - need + MOVED)
    for at in range(rows.shape[1] - width + 1):
        part = rank[:, at : at + width]
        asked[:, at : at + width] |= part <= np.partition(part, k, axis=1)[:, k : k + 1]
    r, c = np.nonzero(asked & (rows > 0))
    once = np.unique(r * np.int64(len(token)) + code[r, c])
    return once // len(token), once % len(token)


def meeting(row: np.ndarray, token: np.ndarray, root: np.ndarray, uid: np.ndarray, most: int = 1 << 21):
    """Pairs of rows of different texts with a token in common whose roots differ, some at a time."""
    by = np.lexsort((row, token))
    row, token = row[by], token[by]
    start = common.key_starts([token])
    size = np.diff(np.append(start, len(token)))
    differ = np.zeros(len(start), bool)
    if len(row):
        differ = (np.minimum.reduceat(root[row], start) != np.maximum.reduceat(root[row], start)) & (np.minimum.reduceat(uid[row], start) != np.maximum.reduceat(uid[row], start))
    start, size = start[differ], size[differ]
    own, first, n = np.repeat(start, size), np.repeat(start, size), np.repeat(size, size)
    own = own + np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size)  # each place of a list
    first, n = own + 1, first + n - own - 1  # with those after it
    at, done = 0, np.cumsum(n)
    while at < len(own):
        to = max(at + 1, int(np.searchsorted(done, (done[at - 1] if at else 0) + most, side="right")))
        a, b = common.cross_segments(own[at:to], np.ones(to - at, np.int64), first[at:to], n[at:to])
        i, j = row[a], row[b]
        apart = (root[i] != root[j]) & (uid[i] != uid[j])
        i, j = i[apart], j[apart]
        yield np.divmod(np.unique(np.minimum(i, j) * np.int64(len(root)) + np.maximum(i, j)), len(root))
        at = to


def compare(uid: np.ndarray, rows: np.ndarray, start: np.ndarray, end: np.ndarray, side: np.ndarray, width: int, need: int, least: int = 64) -> Reaches:
    """Links among the rows of each group [start, end), between different texts (and sides, if it has two).

    Small groups are compared pair by pair. In larger ones equal stretches are found first, then what lies near a
    leader; other pairs are looked at where they aren't in one tree yet and share a rare token.
    """
    out = Reaches(len(uid), rows.shape[1] // 2)

    def look(i, j):
        for at in range(0, len(i), 1 << 14):
            p, q = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
            near = ((rows[p] == rows[q]) & (rows[p] > 0)).sum(1) >= min(ALIGNED, need)
            p, q = p[near], q[near]
            if len(p):
                ok, lo, hi = stretches(rows[p], rows[q], width, need)
                if ok.any():
                    out.add(p[ok], q[ok], lo[ok], hi[ok])

    def meets(i, j):
        return (uid[i] != uid[j]) & ((side[i] == 2) | (side[i] != side[j]))

    size = end - start
    small = (size > 1) & (size <= least)
    for g in np.array_split(np.flatnonzero(small), max(1, int((size[small] ** 2).sum()) >> 20)):
        i, j = common.cross_segments(start[g], size[g], start[g], size[g])
        ok = (i < j) & meets(i, j)
        look(i[ok], j[ok])
    for s, e in zip(start[size > least], end[size > least]):
        mine = np.arange(s, e)
        i, j, lo, hi = equal_stretches(rows[s:e], uid[s:e], width)
        if len(i):
            out.add(i + s, j + s, lo, hi)
        led = np.zeros(e - s, bool)
        for _ in range(8):
            rest = np.flatnonzero(~led)
            if not len(rest):
                break
            leader = s + rest[0]
            others = mine[meets(mine, np.full(e - s, leader)) & (out.root[s:e] != out.root[leader])]
            look(np.full(len(others), leader), others)
            led |= out.root[s:e] == out.root[leader]
        if (out.root[s:e] == out.root[s]).all():
            continue
        r, token = rare_tokens(rows[s:e], width, need)
        for pairs in meeting(r, token, out.root[s:e], uid[s:e]):
            i, j = pairs[0] + s, pairs[1] + s
            ok = meets(i, j)
            i, j = i[ok], j[ok]
            for at in range(0, len(i), 1 << 14):
                p, q = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
                apart = out.root[p] != out.root[q]
                look(p[apart], q[apart])
    return out


def linked(width: int, need: int):
    """Links of whole groups ``key, tile`` of rows sorted by key, tile, side, span and text."""

    def work(batches):
        for table in common.runs(batches, ["key", "tile"], 20_000):
            key, tile, side, uid, span = (table[n].to_numpy() for n in ("key", "tile", "side", "uid", "span"))
            places = Places.read(table["places"])
            rows = np.frombuffer(b"".join(table["around"].to_pylist()), np.uint16).reshape(len(key), -1)
            group = np.cumsum(np.append(True, (key[1:] != key[:-1]) | (tile[1:] != tile[:-1]) | (side[1:] != side[:-1]))) if len(key) else key
            head, second = classes_in(group, span, uid, rows)
            me = np.arange(len(key))
            i = np.flatnonzero((uid != uid[head]) | (second >= 0))
            yield link_rows(uid, places, rows, i, np.where(uid[i] != uid[head[i]], head[i], second[i]), *whole(rows, i))
            stays = np.flatnonzero((head == me) | (second == me))
            key, tile, side, uid, rows, places = key[stays], tile[stays], side[stays], uid[stays], rows[stays], places.take(stays)
            start = common.key_starts([key, tile])
            got = compare(uid, rows, start, np.append(start[1:], len(key)), side, width, need)
            for partner, lo, hi in ((got.by_lo, got.lo, None), (got.by_hi, None, got.hi)):
                i = np.flatnonzero(partner >= 0)
                ok, a, b = stretches(rows[i], rows[partner[i]], width, need)
                _, a2, b2 = stretches(rows[partner[i]], rows[i], width, need)
                yield link_rows(uid, places, rows, i, partner[i], np.where(ok, a, a2), np.where(ok, b, b2))
            if got.links:
                i, j = (np.array(v) for v in zip(*got.links))
                middle = np.full(len(i), rows.shape[1] // 2)
                yield link_rows(uid, places, rows, i, j, middle, middle - SHINGLE + 1)

    return work


def near_passages(docs: DataFrame, least_words: int = LEAST_WORDS, similarity: float = SIMILARITY, hashes: int = HASHES, crowd: int = CROWD) -> DataFrame:
    """Per row of ``docs``: passages of at least ``least_words`` words that nearly repeat in another document.

    Equal texts are one in the search, and of documents that have one text all of it is a passage.

    ``doc_id, n_words, n_dup_words, n_passages, class_id, passages array<struct<from, to>>`` (words, from 0,
    to exclusive; maximal after union). ``class_id``: the smallest doc_id reachable over verified passages,
    itself included. Null and short texts have none. Rows that repeat id and text share one result and
    don't count as another document; other rows that repeat an id do. A null doc_id names a class only if it
    has no other. Every exact passage is found; one at the similarity is missed where no function agrees, or
    where words were put in or left out so that it holds no stretch of the least length in place.
    """
    spark = docs.sparkSession
    common.bounded_batches(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"))
    base = base.withColumn("uid", F.xxhash64("text"))
    texts = base.where(F.octet_length("text") >= 2 * least_words - 1).select("uid", "text")
    every = common.cut(base.select("doc_id", "uid", F.regexp_count("text", F.lit("[^ \t\n\u000b\f\r]+")).alias("n_words")), "ids")
    rows = every.groupBy("uid").agg(F.count("*").alias("size"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("doc_id").alias("named"), F.first("n_words").alias("n"))
    several = (F.col("least") < F.col("most")) | ((F.col("named") > 0) & (F.col("named") < F.col("size")))
    rows = common.cut(rows.select("uid", "size", "least", (F.coalesce(several, F.lit(False)) & (F.col("n") >= least_words)).alias("copied"), "n"), "texts")
    single = texts.dropDuplicates(["uid"]) if rows.where("size > 1").limit(1).count() else texts
    width = least_words - SHINGLE + 1
    need = int(np.ceil(width * 2 * similarity / (1 + similarity) - 1e-9))
    n_parts = common.shuffle_parts(spark)
    thin = texts.mapInArrow(thin_windows(width, hashes), THIN).repartition(n_parts, "route").sortWithinPartitions("route")
    asked = thin.mapInArrow(shared_only, "uid long, at int").groupBy("uid").agg(F.collect_list("at").alias("ats"))  # a text's own windows
    found = common.cut(single.join(asked, "uid").select("uid", "text", "ats").mapInArrow(holders(width, hashes), HOLDERS), "holders")
    held = found.where("key is not null").select("key", "uid", "places", "span", "around")
    crowded = common.cut(held.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("key", F.ceil(F.col("n") / crowd).cast("int").alias("n")), "crowded")
    placed = held.join(common.small(crowded), "key", "left")
    n = F.coalesce("n", F.lit(1))
    own = F.pmod(F.xxhash64("uid", "span"), n).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.struct((F.least(own, j) * n + F.greatest(own, j)).alias("tile"), F.when(own == j, 2).when(own < j, 0).otherwise(1).alias("side")))
    placed = placed.select("key", F.inline(F.when(n == 1, F.array(F.struct(F.lit(0).alias("tile"), F.lit(2).alias("side")))).otherwise(tiles)), "uid", "places", "span", "around")
    met = placed.repartition(n_parts, "key", "tile").sortWithinPartitions("key", "tile", "side", "span", "uid")
    links = met.mapInArrow(linked(width, need), HOLDERS).unionByName(found.where("key is null")).select("uid", "other", "from", "to").distinct()
    verified = common.cut(links, "verified")
    for table in (found, crowded):
        common.drop_cut(table)
    comp = common.components(verified.select(F.col("uid").alias("u"), F.col("other").alias("v")))
    spans = verified.where("`to` > `from`").groupBy("uid").agg(F.collect_set(F.struct("from", "to")).alias("spans"))  # a text's own passages
    named = comp.join(rows.select(F.col("uid").alias("node"), "least"), "node").groupBy("root").agg(F.min("least").alias("class_id"), F.count("*").alias("members"))
    classes = common.spread_join(comp, named, ["root"], "members").select(F.col("node").alias("uid"), "class_id")

    @F.arrow_udf("array<struct<`from`: int, `to`: int>>")
    def union(spans: pa.Array) -> pa.Array:
        out = []
        for s in spans.to_pylist():
            if s is None:
                out.append([])
                continue
            whole: list[list[int]] = []
            for a, b in sorted((x["from"], x["to"]) for x in s):
                if whole and a <= whole[-1][1]:
                    whole[-1][1] = max(whole[-1][1], b)
                else:
                    whole.append([a, b])
            out.append([{"from": a, "to": b} for a, b in whole])
        return pa.array(out, pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())])))

    found = rows.join(spans, "uid", "left").join(classes, "uid", "left")
    whole = F.array(F.struct(F.lit(0).alias("from"), F.col("n").cast("int").alias("to")))
    found = found.withColumn("passages", F.when(F.col("copied"), whole).otherwise(union("spans"))).withColumn("class_id", F.coalesce("class_id", F.when(F.col("copied"), F.col("least"))))
    out = common.spread_join(every, found.select("uid", "size", "passages", "class_id"), ["uid"], "size")
    dup = F.aggregate("passages", F.lit(0), lambda n, p: n + p["to"] - p["from"])
    return out.select("doc_id", F.col("n_words").cast("long").alias("n_words"), dup.cast("long").alias("n_dup_words"), F.size("passages").cast("long").alias("n_passages"), F.coalesce("class_id", "doc_id").alias("class_id"), "passages")


def op9_substring_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_passages(common.documents(spark, sf_dir))
