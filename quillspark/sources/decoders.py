"""Page texts of files that a user's decoder reads (PDFs, for example); no decoder is shipped.

A decoder is a function of a file's bytes and a list of regions (or None for whole pages) that yields, for each
page, one text per region, with ``<fs:N>`` where the size changes. It runs in the executors' Python workers.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.session import ship

#: Three regions of a page that holds three leaves, from the top (left, bottom, width, height as shares of the page).
REGIONS = [(0.094, 0.645, 0.836, 0.24), (0.094, 0.382, 0.836, 0.24), (0.094, 0.128, 0.836, 0.24)]
SENTINEL = "ZZZZ"


def decode_files(
    files: DataFrame, decoder: Callable[[bytes, list | None], Iterable[list[str]]], regions: list | None = None, single_page: str | None = None,
    denied: list[str] = (), single_files: list[str] = (), collapse: bool = True, sentinel: str = SENTINEL,
) -> tuple[DataFrame, DataFrame]:
    """``path, text`` of ``path, content``, and issues ``path, code, detail``.

    A page's regions come out in order, each after the sentinel on a line of its own. Paths that match
    ``single_page`` or are in ``single_files`` are read as whole pages. Files in ``denied`` (few, by path) have
    null text and no issue unless they are in ``single_files``. Null content, and a file at which the decoder
    fails, have null text and an issue. ``collapse``: empty lines go.
    """
    ship(files.sparkSession)
    refused = set(denied) - set(single_files)

    def work(batches):
        for batch in batches:
            rows = []
            for path, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if path in refused:
                    rows.append((path, None, None, None))
                    continue
                if raw is None:
                    rows.append((path, None, "NO_CONTENT", None))
                    continue
                whole = regions is None or path in single_files or bool(single_page and re.search(single_page, path or ""))
                try:
                    text = "".join(f"\n{sentinel}\n{part}" for page in decoder(raw, None if whole else regions) for part in page)
                except Exception as e:  # a user's decoder may raise anything; its file becomes an issue
                    rows.append((path, None, "NOT_DECODED", f"{type(e).__name__}: {e}"[:200]))
                    continue
                rows.append((path, re.sub("\n\n+", "\n", text) if collapse else text, None, None))
            cols = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in cols], ["path", "text", "code", "detail"])

    rows = files.select(F.col("path").cast("string"), F.col("content").cast("binary")).mapInArrow(work, "path string, text string, code string, detail string")
    return rows.select("path", "text"), rows.where("code is not null").select("path", "code", "detail")
