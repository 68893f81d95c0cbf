"""Language identification by cross-parsing entropy over suffix automata.

A bounded sample of labelled text per language becomes one suffix automaton (an automaton of all its
substrings). A text is parsed greedily into the longest phrases that the automaton knows; the language
that codes the text in the fewest bits wins: a phrase costs log2 of the language's own sample length and
its length in Elias gamma code (by the mean phrase), a character that the sample lacks costs LITERAL bits.
Each language has its own alphabet. The automata are tables of next states, dense ones for small alphabets
and sorted transitions for large ones, in which a missing transition restarts at the root and counts a
phrase, so that a batch of texts is parsed in lockstep with array operations. Texts are cut into segments of
``SEGMENT`` characters that are parsed one by one (one more phrase for each, in every language); all
segments of a text count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.llm import common

#: Bounds of the fit: documents and characters per language, characters in all (of which each language may have DOC_CHARS at least), characters of a document (from a hashed offset).
SAMPLE_DOCS, SAMPLE_CHARS, TOTAL_CHARS, DOC_CHARS = 300, 60_000, 400_000, 2_000
#: Parts in which a language's texts are ranked first.
SALTS = 64
#: Columns of the widest dense table; languages with more characters have sorted transitions.
DENSE = 96
#: Bits of a character that a sample lacks.
LITERAL = 20
SEGMENT = 1024
UNKNOWN = "und"


def letters_only(text: str) -> str:
    """Lower case, each run of other characters than letters as one space."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def automaton(text: str) -> tuple[list[dict[str, int]], list[int]]:
    """Transitions of the suffix automaton of a text (online construction)."""
    nxt: list[dict[str, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in text:
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p == -1:
            link[cur] = 0
        else:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt, length


class Table:
    """Steps of a language: next state * 2, plus 1 if the character starts a phrase.

    A character that the sample lacks (the last column) is a phrase of its own and leads back to the root.
    """

    def __init__(self, text: str):
        nxt, _ = automaton(text)
        self.size = len(text)
        self.column = {c: i for i, c in enumerate(sorted(set(text)))}
        self.width = len(self.column) + 1
        state = np.repeat(np.arange(len(nxt)), [len(e) for e in nxt])
        column = np.array([self.column[c] for e in nxt for c in e], np.int64)
        target = np.array([t for e in nxt for t in e.values()], np.int32) * 2
        self.root = np.ones(self.width, np.int32)
        self.root[column[state == 0]] = target[state == 0] | 1
        self.steps = None
        self.states = len(nxt)
        key = (state * self.width + column)[state > 0]
        by = np.argsort(key)
        self.keys, self.targets = key[by], target[state > 0][by]

    def fill(self) -> None:
        """The dense table of a small alphabet, at the first use: the driver, which only learns, has none."""
        if self.steps is None and self.width <= DENSE:
            self.steps = np.tile(self.root, self.states)
            self.steps[self.keys] = self.targets

    def __getstate__(self):
        """Dense tables don't travel."""
        return self.__dict__ | {"steps": None}

    def step(self, state: np.ndarray, column: np.ndarray) -> np.ndarray:
        if self.steps is not None:
            return np.take(self.steps, state * self.width + column)
        key = state.astype(np.int64) * self.width + column
        at = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
        return np.where(self.keys[at] == key, self.targets[at], self.root[column]) if len(self.keys) else self.root[column]


class Model:
    """Automata of the languages; every character of any sample has a code of its own, all others share one."""

    def __init__(self, texts: dict[str, str]):
        texts = {k: v for k, v in sorted(texts.items()) if v}
        self.languages = list(texts)
        self.tables = [Table(v) for v in texts.values()]
        letters = sorted(set().union(*texts.values()))
        self.lookup = np.ones(0x110000, np.int32)  # 0: padding, 1: in no sample
        for i, c in enumerate(letters):
            self.lookup[ord(c)] = i + 2
        self.columns = [np.array([0, t.width - 1] + [t.column.get(c, t.width - 1) for c in letters], np.int32) for t in self.tables]
        self.pointer_bits = np.array([np.log2(max(t.size, 2)) for t in self.tables])

    def phrases(self, codes: list[np.ndarray]) -> np.ndarray:
        """Phrases of each coded text in each language, all texts in lockstep."""
        return self.parsed(codes)[0]

    def parsed(self, codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases, and characters that the sample lacks, of each coded text in each language."""
        out, lacking = (np.zeros((len(codes), len(self.languages)), np.int64) for _ in range(2))
        owner, pieces = [], []
        for i, c in enumerate(codes):
            for at in range(0, len(c), SEGMENT):
                owner.append(i)
                pieces.append(c[at : at + SEGMENT])
        if not pieces:
            return out, lacking
        size = np.array([len(p) for p in pieces])
        order = np.argsort(-size, kind="stable")
        size, owner = size[order], np.array(owner)[order]
        lanes = np.zeros((int(size[0]), len(pieces)), np.int32)
        for k, j in enumerate(order):
            lanes[: size[k], k] = pieces[j]
        live = np.searchsorted(-size, -np.arange(SEGMENT), side="left")  # lanes longer than step
        for g, (steps, columns) in enumerate(zip(self.tables, self.columns)):
            steps.fill()
            state, begun, absent = (np.zeros(len(pieces), np.int32) for _ in range(3))
            other = steps.width - 1
            for t in range(int(size[0])):
                n = live[t]
                column = np.take(columns, lanes[t, :n])
                x = steps.step(state[:n], column)
                begun[:n] += x & 1
                absent[:n] += column == other
                np.right_shift(x, 1, out=state[:n])
            np.add.at(out[:, g], owner, begun)
            np.add.at(lacking[:, g], owner, absent)
        return out, lacking

    def cost(self, phrases: np.ndarray, lacking: np.ndarray, size: int) -> np.ndarray:
        """Bits a character in each language."""
        matched = phrases - lacking
        mean = np.maximum(1, (size - lacking) / np.maximum(1, matched))
        return (matched * (self.pointer_bits + 1 + 2 * np.log2(mean)) + lacking * LITERAL) / size

    def predict(self, texts: list[str | None], batch_chars: int = 1 << 21) -> list[tuple[str, float]]:
        """(language, score) of whole texts; score: how much cheaper the best language is than the next (equal: 0).

        Of languages with the same cost the first by name is said.
        """
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        todo, coded, chars = [], [], 0

        def settle():
            for i, c, row, lacking in zip(todo, coded, *self.parsed(coded)):
                if not self.languages:
                    continue
                cost = self.cost(row, lacking, len(c))
                best = int(np.argmin(cost))
                rest = np.delete(cost, best)
                score = 1.0 if not len(rest) else float(1 - cost[best] / rest.min())
                out[i] = (self.languages[best], min(1.0, max(0.0, score)))
            todo.clear()
            coded.clear()

        for i, text in enumerate(texts):
            plain = letters_only(text) if text else ""
            if not plain:
                continue
            todo.append(i)
            coded.append(self.lookup[np.frombuffer(plain.encode("utf-32-le"), np.uint32)])
            chars += len(plain)
            if chars >= batch_chars:
                settle()
                chars = 0
        if todo:
            settle()
        return out


def labelled(docs: DataFrame) -> DataFrame:
    """Documents that may teach: with text, a lang, and crc32 of the id not 2 modulo 4."""
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("doc_id").isNull() | ~held_out()))


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS) -> Model:
    """Learn every label, from at most ``sample_docs`` documents and ``sample_chars`` characters of each.

    Equal texts count once. The sample is the texts whose hash comes first; of a long one it takes
    ``DOC_CHARS`` characters from a hashed offset. A language keeps its own sample length, however short.
    One pass hashes texts, one reads the chosen ones; the driver gets the sample only.
    """
    at = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - DOC_CHARS, F.lit(1))) + 1
    part = F.col("text").substr(at.cast("int"), F.lit(DOC_CHARS))
    h = F.xxhash64(F.lit(1), "text")
    ids = labelled(docs).where(part.rlike(r"\p{L}")).select("lang", h.alias("h")).distinct()
    top = ids.withColumn("salt", F.pmod("h", F.lit(SALTS)))
    for by in (["lang", "salt"], ["lang"]):  # a language's least hashes are among those of its parts
        top = top.withColumn("k", F.row_number().over(Window.partitionBy(*by).orderBy("h"))).where(F.col("k") <= sample_docs)
    last = top.groupBy("lang").agg(F.max("h").alias("last"))  # a row per language
    chosen = labelled(docs).select("lang", h.alias("h"), part.alias("part")).join(F.broadcast(last), "lang").where("h <= last")
    texts: dict[str, list[str]] = {}
    for r in chosen.select("lang", "part").distinct().orderBy("lang", F.xxhash64("part"), "part").collect():
        texts.setdefault(r["lang"], []).append(letters_only(r["part"]))
    size = min(sample_chars, max(DOC_CHARS, TOTAL_CHARS // max(1, len(texts))))
    model = Model({k: " ".join(x for x in v if x)[:size] for k, v in texts.items()})
    common.release()  # the automata were built in the driver
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; the text alone decides. Null or letterless text: ``und``, 0.

    Rows map one to one, so repeated rows and ids stay. Without labelled text everything is ``und``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        m = shared.value
        for batch in batches:
            got = m.predict(batch.column(2).to_pylist())
            common.release()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(held_out(), F.lit(False)).alias("held_out"), F.col("text"))
    return rows.mapInArrow(work, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs``, whatever their names; ``lang`` becomes the predicted language, and texts without one go.

    Repeated rows stay as they are; without labelled text no text has a language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def language(text: pa.Array) -> pa.Array:
        said = [x[0] for x in shared.value.predict(text.to_pylist())]
        common.release()
        return pa.array(said, pa.string())

    language = language.asNondeterministic()  # else the filter and the column would each call it
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), language("text").alias("said")).where(F.col("said") != UNKNOWN)
    return rows.select(*[F.col("said").alias(c) if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns])


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return predict(docs, fit(docs))
