"""Packing of token pieces into sequences by a grouping genetic algorithm on distributed islands.

Documents are encoded with a local tokenizer file; only those longer than a sequence are cut. The pieces are
dealt by their number into blocks of bounded size. A block is packed by best fit decreasing; where that needs
no more bins than a lower bound allows, nothing can be better and the block is done. Every other block evolves
on several islands, each a task of its own: a child injects well-filled bins of one parent into the other,
bins that hold the same documents are dissolved, and the displaced documents go where they fit best. Between
the epochs the islands' packings are written to the shared folder, and each island reads the elite of the one
before it. Of a block's islands the best packing counts. Well-filled bins are settled; the worst-filled bins
of all blocks are thrown together for another round, until one block holds them all.
"""

from __future__ import annotations

import functools
import os
import random
import string
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.llm import common

CAPACITY, END_ID = 4096, 1
#: Pieces in a block, share of its bins that go on to the next round.
BLOCK, GO_ON = 2000, 0.06
#: Islands of a block, packings on an island, epochs with a migration between them, generations in an epoch, and
#: generations without fewer bins after which an island waits for the next guest.
ISLANDS, POPULATION, EPOCHS, GENERATIONS, PATIENCE = 4, 6, 3, 80, 15
#: Words whose ids a worker remembers, and characters of a word that is worth it.
CACHE_WORDS, CACHE_CHARS = 800_000, 40
SEPARATOR = "|"
SIGNS = string.punctuation
LATIN = {chr(i) for i in range(256)}


def _as_bytes() -> dict[int, str]:
    """Letters from U+0080 to U+00FF as the byte-level alphabet writes their UTF-8 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in shown):
        shown[b] = chr(256 + n)
    return {i: "".join(shown[b] for b in chr(i).encode()) for i in range(128, 256)}


AS_BYTES = _as_bytes()

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class WordEncoder:
    """Ids of whole texts by a tokenizer that never matches across white space, remembering words.

    Names of special tokens in a text become those tokens, as the library has it, unless ``plain_names``.
    """

    _by_file: dict[tuple, "WordEncoder"] = {}

    def __init__(self, file: str, plain_names: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = plain_names
        self.separator = self.tokenizer.encode(SEPARATOR, add_special_tokens=False).ids
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {"": b""}

    @classmethod
    def of(cls, file: str, plain_names: bool = False) -> "WordEncoder":
        if (file, plain_names) not in cls._by_file:
            cls._by_file[file, plain_names] = cls(file, plain_names)
        return cls._by_file[file, plain_names]

    def forget(self) -> None:
        self.known.clear()
        self.known[""] = b""

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words: plain ones together in one text, with a one-token separator between them."""
        got = {}
        plain = [w for w in words if SEPARATOR not in w and len(w) <= CACHE_CHARS]
        if len(self.separator) != 1:
            plain = []
        for at in range(0, len(plain), 2000):
            part = plain[at : at + 2000]
            ids = np.array(self.tokenizer.encode(f" {SEPARATOR} ".join(part), add_special_tokens=False).ids, "<u4")
            ends = np.append(np.flatnonzero(ids == self.separator[0]), len(ids)) * 4
            raw, begin = ids.tobytes(), 0
            if len(ends) != len(part):
                plain = []
                break
            for w, end in zip(part, ends.tolist()):
                got[w] = raw[begin:end]
                begin = end + 4
        rest = [w for w in words if w not in got]
        for at in range(0, len(rest), 500):
            part = rest[at : at + 500]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                got[w] = np.array(e.ids, "<u4").tobytes()
        return got

    def compose(self, words: list[str]) -> dict[str, bytes]:
        """Ids of unknown words: Latin letters with ASCII signs after them from their parts, others by learn().

        Such letters are one match of the split pattern and the signs another, whatever the case, so each
        stem goes to the model once, without the normaliser.
        """
        known, model, rest, got, signs = self.known, self.model, [], {}, {}
        for w in words:
            stem = w.rstrip(SIGNS)
            if not stem.isalpha() or not (stem.isascii() or LATIN.issuperset(stem)) or len(w) > CACHE_CHARS:
                rest.append(w)
                continue
            low = stem.lower()
            ids = known.get(low)
            if ids is None:
                ids = known[low] = array("I", [t.id for t in model.tokenize(low if low.isascii() else low.translate(AS_BYTES))]).tobytes()
            if len(stem) < len(w):
                tail = w[len(stem) :]
                if tail not in known and tail not in signs:
                    signs.update(self.learn([tail]))
                ids += known[tail] if tail in known else signs[tail]
            got[w] = ids
        known.update(signs)
        return got | self.learn(rest)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        known, out = self.known, []
        for text in texts:
            words = text.replace("\n", " ").split(" ")
            ids = list(map(known.get, words))
            try:
                out.append(b"".join(ids))
            except TypeError:  # None: words that are new
                new = self.compose(list({w for w, i in zip(words, ids) if i is None}))
                out.append(b"".join([new[w] if i is None else i for w, i in zip(words, ids)]))
                known.update((w, i) for w, i in new.items() if len(w) <= CACHE_CHARS)
            if len(known) > CACHE_WORDS:
                self.forget()
        return out


def token_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, plain_names: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: a document's ids and the end id, cut only beyond ``capacity``.

    Null text is empty: its single piece is the end id.
    """
    end = np.array([END_ID], "<u4").tobytes()

    def work(batches):
        encoder = WordEncoder.of(tokenizer_file, plain_names)
        try:
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), [x or "" for x in batch.column(1).to_pylist()]
                rows = []
                for at in range(0, len(ids), 256):
                    for doc, raw in zip(ids[at : at + 256], encoder.encode(texts[at : at + 256])):
                        raw += end
                        for k, s in enumerate(range(0, len(raw), 4 * capacity)):
                            part = raw[s : s + 4 * capacity]
                            rows.append((doc, k, s // 4, len(part) // 4, zlib.crc32(part)))
                cols = list(zip(*rows)) if rows else [[]] * 5
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])
        finally:  # workers outlive the task, and their words would add up
            encoder.forget()
            common.release()

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(work, PIECES)


class Bins:
    """Open bins by free room: the tightest one that takes a length is found in a bit mask."""

    def __init__(self, capacity: int):
        self.capacity, self.mask, self.by_room, self.items, self.fill = capacity, 0, {}, [], []

    def add_bin(self, items: list[int], fill: int) -> None:
        self.items.append(items)
        self.fill.append(fill)
        self._open(len(self.items) - 1)

    def _open(self, b: int) -> None:
        room = self.capacity - self.fill[b]
        if room:
            self.by_room.setdefault(room, []).append(b)
            self.mask |= 1 << room

    def best_fit(self, item: int, length: int) -> None:
        m = self.mask >> length
        if not m:
            self.add_bin([item], length)
            return
        room = length + (m & -m).bit_length() - 1
        bins = self.by_room[room]
        b = bins.pop()
        if not bins:
            self.mask ^= 1 << room
        self.items[b].append(item)
        self.fill[b] += length
        self._open(b)


def packed(order, length, capacity: int, whole: list[tuple[list[int], int]] = ()) -> list[tuple[list[int], int]]:
    """Bins after best fit of ``order``, on top of whole bins that are there already."""
    bins = Bins(capacity)
    for items, fill in whole:
        bins.add_bin(list(items), fill)
    for i in order:
        bins.best_fit(i, length[i])
    return list(zip(bins.items, bins.fill))


def least_bins(length: list[int], capacity: int) -> int:
    """A lower bound: for each k, pieces above ``capacity - k`` stand alone, those above half a bin share none, and
    what remains of at least k fills the room that these leave, then bins of its own.
    """
    x = np.sort(np.asarray(length, np.int64))
    total = np.append(0, np.cumsum(x))
    half = np.searchsorted(x, capacity // 2, side="right")
    k = np.unique(np.append(x[:half], 0))
    big = np.searchsorted(x, capacity - k, side="right")  # from here pieces stand alone
    small = np.searchsorted(x, k, side="left")
    room = (big - half) * capacity - (total[big] - total[half])
    more = np.maximum(0, -(-(total[half] - total[small] - room) // capacity))
    return int((len(x) - half + more).max(initial=0)) if len(x) else 0


def cost(bins, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the more unequal filling."""
    return len(bins), -sum((f / capacity) ** 2 for _, f in bins)


def child(a, b, length, capacity: int, rng: random.Random):
    """Inject well-filled bins of b into a, dissolve a's bins that share documents, best-fit the displaced.

    Some bins of the child that aren't full are dissolved too, so that new combinations come up.
    """
    best = sorted(b, key=lambda x: -x[1])
    take = best[: max(1, int(len(best) * rng.uniform(0.2, 0.6)))]
    taken = {i for items, _ in take for i in items}
    keep, loose = list(take), []
    for items, fill in a:
        if taken.isdisjoint(items):
            keep.append((items, fill))
        else:
            loose += [i for i in items if i not in taken]
    open_ = [k for k, (_, fill) in enumerate(keep) if fill < capacity]
    gone = set(rng.sample(open_, min(len(open_), max(1, len(keep) // 10))))
    for k in gone:
        loose += keep[k][0]
    keep = [x for k, x in enumerate(keep) if k not in gone]
    noise = rng.choice([1.0, 0.95, 0.8])
    loose.sort(key=lambda i: -length[i] * rng.uniform(noise, 1))
    return packed(loose, length, capacity, keep)


def as_bins(numbers, length: list[int]) -> list[tuple[list[int], int]]:
    """Bins from the bin number of each piece."""
    held: dict[int, list[int]] = {}
    for i, b in enumerate(numbers):
        held.setdefault(b, []).append(i)
    return [(items, sum(length[i] for i in items)) for items in held.values()]


def as_numbers(bins, n: int) -> np.ndarray:
    out = np.zeros(n, np.int32)
    for b, (items, _) in enumerate(bins):
        out[items] = b
    return out


def first_group(length: list[int], capacity: int, rng: random.Random, population: int) -> list:
    """Best fit in decreasing order, and in noisy decreasing orders."""
    down = sorted(range(len(length)), key=lambda i: -length[i])
    return [packed(down, length, capacity)] + [packed(sorted(down, key=lambda i: -length[i] * rng.uniform(0.7, 1)), length, capacity) for _ in range(population - 1)]


def evolve(length: list[int], capacity: int, seed: int, group: list | None = None, population: int = POPULATION, generations: int = GENERATIONS) -> list:
    """An island's packings after some generations, best first; deterministic for a seed."""
    rng = random.Random(seed)
    least = least_bins(length, capacity)
    group = group or first_group(length, capacity, rng, population)
    group.sort(key=lambda x: cost(x, capacity))
    fewest, idle = len(group[0]), 0
    for _ in range(generations):
        if len(group[0]) <= least or len(group) < 2 or idle >= PATIENCE:
            break
        a, b = rng.sample(range(len(group)), 2)
        group += [child(group[a], group[b], length, capacity, rng), child(group[b], group[a], length, capacity, rng)]
        group.sort(key=lambda x: cost(x, capacity))
        del group[population:]
        idle = idle + 1 if len(group[0]) == fewest else 0
        fewest = len(group[0])
    return group


BINS = "block long, pid long, length long, bin int, `open` boolean"
ISLAND = "block long, island int, pid long, length long, bins array<int>, cost double"


def best_fit_blocks(capacity: int):
    """Best fit decreasing of a block; ``open`` where the lower bound leaves hope for fewer bins."""

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("pid")
        length = table["length"].to_pylist()
        bins = packed(sorted(range(len(length)), key=lambda i: -length[i]), length, capacity)
        hope = len(bins) > least_bins(length, capacity)
        return table.append_column("bin", pa.array(as_numbers(bins, len(length)))).append_column("open", pa.array(np.full(len(length), hope)))

    return work


def island_epoch(capacity: int, epoch: int):
    """An island's generations: it starts with packings of its own, or with those written before and a guest's elite."""

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("pid")
        length = table["length"].to_pylist()
        block, island = table["block"][0].as_py(), table["island"][0].as_py()
        group = None
        if epoch:
            numbers = np.array(table["bins"].to_pylist(), np.int32)
            group = [as_bins(numbers[:, k].tolist(), length) for k in range(numbers.shape[1])]
            guest = as_bins(table["guest"].to_pylist(), length)
            group[-1] = guest
        group = evolve(length, capacity, (block * 1009 + island) * 101 + epoch, group)
        numbers = np.stack([as_numbers(g, len(length)) for g in group], 1)
        bins = pa.ListArray.from_arrays(np.arange(len(length) + 1, dtype=np.int32) * numbers.shape[1], pa.array(numbers.ravel()))
        worth = cost(group[0], capacity)
        return pa.table([table["block"], table["island"], table["pid"], table["length"], bins, pa.array(np.full(len(length), worth[0] + worth[1] / (len(length) + 1)))], ["block", "island", "pid", "length", "bins", "cost"])

    return work


def evolved(blocks: DataFrame, capacity: int, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """``block, pid, length, bin`` of the best packing among the islands of each block ``block, pid, length``."""
    spread = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "pid", "length")
    state = None
    for epoch in range(epochs):
        if state is not None:
            guest = state.select("block", ((F.col("island") + 1) % islands).cast("int").alias("island"), "pid", F.get("bins", F.lit(0)).alias("guest"))
            spread = state.drop("cost").join(guest, ["block", "island", "pid"])
        before, state = state, common.cut(spread.repartition(common.shuffle_parts(blocks.sparkSession), "block", "island").groupBy("block", "island").applyInArrow(island_epoch(capacity, epoch), ISLAND), "islands")
        if before is not None:
            common.drop_cut(before)
    best = state.groupBy("block").agg(F.min(F.struct("cost", "island")).alias("x")).select("block", F.col("x.island").alias("island"))
    return state.join(best, ["block", "island"]).select("block", "pid", "length", F.get("bins", F.lit(0)).alias("bin"))


def settle(bins: DataFrame, capacity: int, stage: int, more: bool) -> DataFrame:
    """``pid, length, sequence_id, offset, settled`` of rows ``block, pid, length, bin``; with ``more`` the worst-filled
    bins of each block aren't settled.
    """
    whole = Window.partitionBy("block", "bin")
    rows = bins.withColumn("fill", F.sum("length").over(whole)).withColumn("offset", F.coalesce(F.sum("length").over(whole.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    sequence = F.lit(stage << 58).bitwiseOR(F.shiftleft("block", 24)).bitwiseOR(F.col("bin").cast("long"))
    settled = F.lit(True)
    if more:
        worst = Window.partitionBy("block").orderBy("fill", "bin")
        rows = rows.withColumn("rank", F.dense_rank().over(worst)).withColumn("n", F.max("rank").over(Window.partitionBy("block")))
        settled = (F.col("rank") > F.greatest(F.lit(1), F.floor(F.col("n") * GO_ON))) | (F.col("fill") == capacity)
    return rows.select("pid", "length", sequence.alias("sequence_id"), F.col("offset").cast("long").alias("offset"), settled.alias("settled"))


def pack(pieces: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, report: dict | None = None) -> DataFrame:
    """Adds ``sequence_id long, offset long`` to rows with ``length`` (1 to ``capacity``).

    Repeated rows are pieces of their own, also in the dealing. An empty table gives an empty result. Sequence
    numbers are unique, not consecutive. ``report`` gets the number of blocks, and of those that evolved.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in pieces.columns])
    numbered = common.cut(pieces.select(row.alias("row"), F.monotonically_increasing_id().alias("pid")), "numbered")
    now = numbered.select("pid", F.col("row.length").cast("long").alias("length"))
    n, done, stage = now.count(), [], 0
    counts = {"blocks": 0, "evolved": 0}
    while n:
        blocks = max(1, -(-n // block))
        dealt = now.select(F.pmod(F.xxhash64("pid", F.lit(stage)), F.lit(blocks)).cast("long").alias("block"), "pid", "length")
        bins = common.cut(dealt.repartition(common.shuffle_parts(pieces.sparkSession), "block").groupBy("block").applyInArrow(best_fit_blocks(capacity), BINS), "bins")
        hopeful = bins.where("open").agg(F.countDistinct("block")).first()[0]
        counts["blocks"] += blocks
        counts["evolved"] += hopeful
        settled = bins.where("not open").drop("open")
        if hopeful:
            settled = settled.unionByName(evolved(bins.where("open").drop("bin", "open"), capacity))
        out = common.cut(settle(settled, capacity, stage, blocks > 1), "packed")
        common.drop_cut(bins)
        done.append(out.where("settled"))
        if blocks == 1:
            break
        now = out.where("not settled").select("pid", "length")
        n, stage = now.count(), stage + 1
    if report is not None:
        report.update(counts)
    places = [out.select("pid", "sequence_id", "offset") for out in done]
    if not places:
        return pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).limit(0)
    return numbered.join(functools.reduce(DataFrame.unionByName, places), "pid").select("row.*", "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, report: dict | None = None) -> DataFrame:
    """Encode, cut and pack; one row per piece. Null doc_ids are packed like others."""
    common.bounded_batches(docs.sparkSession)
    return pack(token_pieces(docs, tokenizer_file, capacity), capacity, report=report)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tok

    return pack_documents(common.documents(spark, sf_dir), tok.path("word_bpe_49k.json"))
