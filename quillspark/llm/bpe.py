"""Byte-level BPE encoding and decoding by the tiktoken library with a local rank file.

Texts longer than ``LONG`` are cut before encoding at safe boundaries, which the split pattern can
never match across, so ids are those of the whole text; ids decode to raw bytes.
"""

from __future__ import annotations

import base64
import functools
import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import common

#: Characters from which a text is pre-split.
LONG = 1 << 16
#: Characters up to which a part goes to the library's own matcher.
PLAIN = 1 << 18
#: A letter, then one space and a letter: every match of the pattern ends before that space.
SAFE = regex.compile(r"(?<=\p{L})(?= \p{L})")

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean"


@functools.lru_cache(maxsize=4)
def encoder(rank_file: str, pattern: str):
    import tiktoken

    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, long: int = LONG):
    """Cut a long text at the first safe boundary after each ``long`` characters; join gives the text back."""
    at = 0
    while len(text) - at > long:
        m = SAFE.search(text, at + long)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def by_pieces(enc, pattern: str, text: str) -> list[int]:
    """Ids of each match of the pattern by itself; the library's own matcher overflows on long runs of white space."""
    return [i for m in regex.finditer(pattern, text) for i in enc._encode_single_piece(m[0])]


def encode(enc, pattern: str, text: str, long: int = LONG) -> np.ndarray:
    """Ids of the whole text; where the library's matcher gives up, the pattern is matched by ``regex``."""
    out = []
    for part in parts(text, long):
        try:
            ids = enc.encode_ordinary(part) if len(part) <= PLAIN else by_pieces(enc, pattern, part)
        except BaseException as e:  # the library's panics derive from no narrower class
            if isinstance(e, (KeyboardInterrupt, MemoryError, SystemExit, GeneratorExit)):
                raise
            ids = by_pieces(enc, pattern, part)
        out.append(np.asarray(ids, "<u4"))
    return np.concatenate(out) if out else np.zeros(0, "<u4")


def bpe_round_trip(docs: DataFrame, rank_file: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Per document: number of ids, digests of the ids and of the decoded bytes, and whether they agree.

    Null text counts as empty (no ids). Rows map one to one, so repeated rows and ids stay as they are.
    ``with_ids`` adds ``ids array<int>`` and ``decoded binary``.
    """

    def work(batches):
        enc = encoder(rank_file, pattern)
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = text.as_py() or ""
                ids = encode(enc, pattern, text)
                raw = enc.decode_bytes(ids.tolist())
                row = [len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(raw).hexdigest(), raw == text.encode()]
                rows.append(row + [ids.astype(np.int32), raw] * with_ids)
            common.release()
            cols = list(zip(*rows)) if rows else [[]] * (4 + 2 * with_ids)
            kinds = [pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.int32()), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(list(c), t) for c, t in zip(cols, kinds)], names)

    schema = SCHEMA + ", ids array<int>, decoded binary" * with_ids
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(work, schema)


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tok

    return bpe_round_trip(common.documents(spark, sf_dir), tok.path("byte_bpe_multi_50k.tiktoken"), tok.PATTERN)
