"""RTF files as tables of runs, and their fonts.

One tokenizer, three dialects. ``v1``: text of a ``\\u`` character may be followed by ``?``; a paragraph
word is recognised by its first letters. ``v2``: ``\\u`` always takes one fallback with it; ``\\par`` is a
whole word. ``v3``: fonts per direction and character set, breaks as rows of their own, groups of metadata
and headers skipped, line ends of the source dropped, white space kept, escaped signs take the format that
is switched right after them. A file is parsed by one task in one pass over its tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.session import ship

RUNS = "doc_id string, seq int, type string, text string, font struct<id: int, name: string, size: int>, char_start int, char_end int"

TOKEN = re.compile(r"(?P<open>\{)|(?P<close>\})|\\(?P<word>[A-Za-z]+)(?P<n>-?\d+)?(?P<space>[ ]?)|\\'(?P<hex>[0-9a-fA-F]{2})|\\(?P<sign>[^A-Za-z])|(?P<text>[^\\{}]+)|(?P<stray>\\)", re.S)
SKIPPED = {"fonttbl", "colortbl", "stylesheet", "info", "listtable", "listoverridetable", "mmathPr", "footer", "header"}
BLOCKS = {"footnote", "header", "footer", "pict"}
BREAKS = {"par": "par_break", "line": "line_break", "cell": "cell_break", "row": "row_break"}
#: Runs and characters of them in one batch that a parser's worker returns.
OUT_ROWS, OUT_CHARS = 5000, 4 << 20
COMPLEX = re.compile(r"\\panose[^}]*\}Dedris", re.S)


def sniff(head: str) -> str:
    """``complex`` for files whose font table nests a classification before the name."""
    return "complex" if COMPLEX.search(head[:100_000]) else "simple"


def group_end(data: str, start: int) -> int:
    """Position after the brace that closes the group open at ``start``; the end if none does."""
    depth = 1
    for m in re.compile(r"[{}]").finditer(data, start):
        depth += 1 if m[0] == "{" else -1
        if not depth:
            return m.end()
    return len(data)


def font_table(data: str, dialect: str) -> dict[int, str]:
    """Font id to name. The first entry of an id wins in v3, the last in v1 and v2."""
    if dialect != "v3":
        return {int(m[1]): re.split(r"\\[A-Za-z]+-?\d*\s?", m[0].rstrip(";}"))[-1].strip() for m in re.finditer(r"\{\\f(\d+)[^;]*;\}", data)}
    at = data.find("{\\fonttbl")
    if at < 0:
        return {}
    body = data[at + len("{\\fonttbl") : group_end(data, at + 1) - 1]
    nested = sniff(data) == "complex"
    out: dict[int, str] = {}
    at = 0
    while (at := body.find("{", at)) >= 0:
        end = group_end(body, at + 1)
        entry, at = body[at + 1 : end - 1], end
        m = re.search(r"\\f(\d+)", entry) if nested else re.match(r"\\f(\d+)", entry)
        if m:
            while nested and "{" in entry:
                flat = re.sub(r"\{[^{}]*\}", " ", entry)
                if flat == entry:
                    break
                entry = flat
            name = re.sub(r"\\'[0-9a-fA-F]{2}", "", re.sub(r"\\[A-Za-z]+-?\d*\s?", "", entry.split(";")[0]))
            out.setdefault(int(m[1]), name.strip())
    return out


def colour_table(data: str) -> list[tuple[int, int, int] | None]:
    """Red, green and blue of each entry of the colour table, None for an automatic one."""
    m = re.search(r"\{\\colortbl([^}]*)\}", data)
    out = []
    for entry in m[1].split(";")[:-1] if m else []:
        part = dict(re.findall(r"\\(red|green|blue)(\d+)", entry))
        out.append(tuple(int(part.get(c, 0)) for c in ("red", "green", "blue")) if part else None)
    return out


def surrogates_joined(text: str) -> str:
    """Pairs of surrogates as one character; halves without their partner go."""
    return text.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "ignore") if any("\ud800" <= c <= "\udfff" for c in text) else text


def parse(data: str, dialect: str = "v3") -> Iterator[tuple]:
    """``type, text, font id, font name, size, char_start, char_end`` in order."""
    fonts = font_table(data, dialect)
    return (_parse_v3 if dialect == "v3" else _parse_simple)(data, fonts, dialect)


def _parse_v3(data: str, fonts: dict[int, str], _: str) -> Iterator[tuple]:
    direction, charset, size = "ltrch", "loch", 24
    font = dict.fromkeys([(d, c) for d in ("ltrch", "rtlch") for c in ("loch", "hich", "dbch")], 0)
    stack: list = []
    held: list[str] = []
    start = at = 0
    out: list[tuple] = []

    def flush(end: int) -> None:
        nonlocal start
        text = surrogates_joined("".join(held)).replace("\r", "").replace("\n", "")
        if text:
            fid = font[direction, charset]
            out.append((None, text, fid, fonts.get(fid, ""), size // 2, start, end))
        held.clear()
        start = end

    def switch(word: str, n: str | None) -> bool:
        nonlocal direction, charset, size
        if word in ("ltrch", "rtlch"):
            direction = word
        elif word in ("loch", "hich", "dbch"):
            charset = word
        elif word in ("f", "af") and n:
            font[direction, charset] = int(n)
        elif word == "fs" and n:
            size = int(n)
        else:
            return False
        return True

    while at < len(data):
        m = TOKEN.match(data, at)
        here, at = at, m.end()
        kind = m.lastgroup if m.lastgroup not in ("n", "space") else "word"
        if m["open"]:
            peek = re.compile(r"\\(\*|[A-Za-z]+)").match(data, at)
            if peek and (peek[1] == "*" or any(peek[1].startswith(s) for s in SKIPPED)):
                at = group_end(data, at)
            else:
                stack.append((size, charset, direction, dict(font)))
        elif m["close"]:
            flush(here)
            if stack:
                size, charset, direction, font = stack.pop()
            start = at
        elif m["word"]:
            word, n = m["word"], m["n"]
            if word == "u" and n:
                code = int(n)
                held.append(chr(code + 0x10000 if code < 0 else min(code, 0x10FFFF)))
                if data.startswith("?", at):
                    at += 1
            elif word in BLOCKS and not n:
                inner = re.compile(r"[ \n\r\t]*(\{)?").match(data, at)
                if inner[1]:
                    end = group_end(data, inner.end())
                    fid = font[direction, charset]
                    out.append((word, data[inner.end() : end - 1], fid, fonts.get(fid, ""), size // 2, inner.end() - 1, end))
                    at = end
            elif word in BREAKS and not n:
                flush(here)
                out.append((BREAKS[word], None, None, None, None, here, at))
                start = at
            elif word in ("ltrch", "rtlch", "loch", "hich", "dbch") or (word in ("f", "af", "fs") and n):
                flush(here)
                switch(word, n)
                start = at
        elif m["hex"]:
            held.append(bytes.fromhex(m["hex"]).decode("latin-1"))
        elif m["sign"]:
            if m["sign"] == "~":
                held.append("\u00a0")
            elif m["sign"] in "{}\\":
                first = True
                while (f := re.compile(r"\\(ltrch|rtlch|loch|hich|dbch|a?f(?=\d)|fs(?=\d))(\d+)?[ ]?").match(data, at)):
                    if first:
                        flush(here)
                        first = False
                    switch(f[1], f[2])
                    at = f.end()
                held.append(m["sign"])
        elif kind == "text":
            held.append(m["text"])
    flush(len(data))
    return iter(out)


def _parse_simple(data: str, fonts: dict[int, str], dialect: str) -> Iterator[tuple]:
    fid, size, stack, held, out = 0, 24, [], [], []
    start = at = 0

    def flush(end: int) -> None:
        """White space alone waits for the next run."""
        nonlocal start
        text = surrogates_joined("".join(held))
        if text.strip():
            out.append((None, text, fid, fonts.get(fid, ""), size // 2, start, end))
            held.clear()
            start = end

    while at < len(data):
        m = TOKEN.match(data, at)
        here, at = at, m.end()
        if m["open"]:
            if data.startswith("{\\*", here) or data.startswith("{\\fonttbl", here):
                at = group_end(data, at)
            else:
                stack.append((fid, size))
        elif m["close"]:
            flush(here)
            if stack:
                fid, size = stack.pop()
        elif m["word"]:
            word, n = m["word"], m["n"]
            if word == "u" and n:
                code = int(n)
                held.append(chr(code + 0x10000 if code < 0 else min(code, 0x10FFFF)))
                if dialect == "v1":
                    at += data.startswith("?", at)
                else:  # one fallback, whatever it is
                    fallback = re.compile(r"\\'[0-9a-fA-F]{2}|[^\\{}]").match(data, at)
                    at = fallback.end() if fallback else at
            elif word in ("f", "fs") and n:
                flush(here)
                fid, size = (int(n), size) if word == "f" else (fid, int(n))
            elif word in BLOCKS and (inner := re.compile(r"[ \n\r\t]*\{").match(data, at)):
                end = group_end(data, inner.end())
                out.append((word, data[inner.end() : end - 1], fid, fonts.get(fid, ""), size // 2, inner.end() - 1, end))
                at = end
            elif word == "par" or (dialect == "v1" and word.startswith("par")):
                held.append("\n" + (word[3:] if dialect == "v1" else ""))
        elif m["hex"]:
            held.append(bytes.fromhex(m["hex"]).decode("latin-1"))
        elif m["sign"] == "~":
            held.append("\u00a0")
        elif m["text"]:
            held.append(m["text"])
    flush(len(data))
    return iter(out)


def batches_of(files: Iterator[tuple], dialect: str) -> Iterator[pa.RecordBatch]:
    """Runs of ``(key, bytes)`` one file after another, in batches of bounded size however many runs there are."""
    kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.struct([("id", pa.int32()), ("name", pa.string()), ("size", pa.int32())]), pa.int32(), pa.int32()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [[]] * 7
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], ["doc_id", "seq", "type", "text", "font", "char_start", "char_end"])

    rows, held = [], 0
    for doc, raw in files:
        for seq, (kind, text, fid, name, size, a, b) in enumerate(parse((raw or b"").decode("utf-8", "ignore"), dialect)):
            rows.append((doc, seq, kind, text, None if fid is None else {"id": fid, "name": name, "size": size}, a, b))
            held += len(text or "")
            if len(rows) >= OUT_ROWS or held >= OUT_CHARS:
                yield batch(rows)
                rows, held = [], 0
    yield batch(rows)


def runs(files: DataFrame, dialect: str = "v3", key: str = "path") -> DataFrame:
    """Runs of every file of ``key, content`` (binary); bytes that are not UTF-8 vanish. Null content has none."""
    ship(files.sparkSession)

    def work(batches):
        yield from batches_of(((doc.as_py(), raw.as_py()) for batch in batches for doc, raw in zip(batch.column(0), batch.column(1))), dialect)

    return files.select(F.col(key).cast("string"), F.col("content").cast("binary")).mapInArrow(work, RUNS)


def longest_first(table: dict[str, str]) -> str:
    """A pattern for the sequences of a table, one group, that takes the longest; by first characters, so that few are
    tried at a place. Empty if there are none.
    """
    rest: dict[str, list[str]] = {}
    for key in sorted((k for k in table if k), key=len, reverse=True):
        rest.setdefault(key[0], []).append(key[1:])
    alone = "".join(re.escape(c) for c, r in rest.items() if r == [""])
    more = [f"{re.escape(c)}(?:{'|'.join(map(re.escape, r))})" for c, r in rest.items() if r != [""]]
    return f"({'|'.join(([f'[{alone}]'] if alone else []) + more)})" if rest else ""


def decode_runs(rows: DataFrame, table: dict[str, dict[str, str]], legacy: str = "Dedris") -> DataFrame:
    """Runs in a legacy font to Unicode by a table font -> longest sequence -> text; others as they are.

    ``table`` is the user's (a few thousand entries). Stray system fonts count as the first legacy font.
    ``decoded`` is false where a font of the family is not in the table, and the text stays. ``unknown`` names each
    character of a run that the font's table lacks once.
    """
    ship(rows.sparkSession)
    known = {f: longest_first(t) for f, t in table.items()}

    def name_of(font: str) -> str | None:
        if font.lower() in ("simsun", "@simsun", "simsun western"):
            return f"{legacy}-a"
        return font if font.startswith(legacy) else None

    def decode(text: str, font: str) -> tuple[str, bool, list[str]]:
        f = name_of(font or "")
        if f is None:
            return text, True, []
        if f not in table:
            return text, False, []
        parts = re.split(known[f], text) if known[f] else [text]
        unknown = set().union(*parts[::2])
        parts[1::2] = map(table[f].__getitem__, parts[1::2])
        return "".join(parts), True, sorted(unknown)

    @F.arrow_udf("struct<text: string, decoded: boolean, unknown: array<string>>")
    def decoded(text: pa.Array, font: pa.Array) -> pa.Array:
        got = [(None, None, None) if t is None else decode(t, f) for t, f in zip(text.to_pylist(), font.to_pylist())]
        return pa.StructArray.from_arrays([pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.bool_()), pa.array([g[2] for g in got], pa.list_(pa.string()))], ["text", "decoded", "unknown"])

    return rows.withColumn("_d", decoded("text", "font.name")).withColumn("_raw", F.col("text")).withColumn("text", F.col("_d.text")).withColumn("decoded", F.col("_d.decoded")).withColumn("unknown", F.col("_d.unknown")).withColumnRenamed("_raw", "source_text").drop("_d")


def decode_stats(rows: DataFrame, legacy: str = "Dedris", samples: int = 50) -> DataFrame:
    """Per font of decoded runs: ``font, kind, n_runs, n_chars, unknown, samples``, fonts in order.

    ``kind``: handled, unhandled (of the family, without a table) or other. ``unknown`` lists the characters
    that the font's table lacks as ``struct<code, char>`` by code point; ``samples`` holds the first 50
    characters of at most ``samples`` runs of other fonts with digits or punctuation, by their place.
    """
    family = F.col("font.name").startswith(legacy) | F.lower("font.name").isin("simsun", "@simsun", "simsun western")
    kind = F.when(~family, "other").when(F.col("decoded"), "handled").otherwise("unhandled")
    some = rows.where("font is not null and source_text is not null").select(F.col("font.name").alias("font"), kind.alias("kind"), "doc_id", "seq", "source_text", "unknown")
    # a run counts in its row without a character, so runs are decoded once and grouped by font and character at once
    chars = F.concat(F.array(F.lit(None).cast("string")), F.coalesce(F.array_distinct("unknown"), F.array().cast("array<string>")))
    counted = some.select("font", "kind", F.length("source_text").alias("n"), F.explode(chars).alias("c")).groupBy("font", "kind", "c").agg(F.count("*").alias("n_runs"), F.sum("n").alias("n_chars"))
    whole = F.col("c").isNull()
    signs = F.collect_list(F.when(~whole, F.struct(F.ascii("c").alias("code"), F.col("c").alias("char"))))
    facts = counted.groupBy("font", "kind").agg(F.max(F.when(whole, F.col("n_runs"))).alias("n_runs"), F.max(F.when(whole, F.col("n_chars"))).alias("n_chars"), F.array_sort(signs).alias("unknown"))
    # the first runs of a font are picked in each partition before they meet; texts don't travel whole
    odd = rows.where("font is not null").where(~family & F.col("source_text").rlike(r"[0-9{}.,;:!?@#$%^&*()\[\]<>]")).select(F.col("font.name").alias("font"), F.lit("other").alias("kind"), "doc_id", "seq", F.left("source_text", F.lit(50)).alias("text"))
    placed = odd.withColumn("_k", F.row_number().over(Window.partitionBy("font").orderBy("doc_id", "seq"))).where(F.col("_k") <= samples)
    sample = placed.groupBy("font", "kind").agg(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "seq", "text"))), lambda x: x["text"]).alias("samples"))
    return facts.join(sample, ["font", "kind"], "left").select("font", "kind", "n_runs", "n_chars", "unknown", F.coalesce("samples", F.array().cast("array<string>")).alias("samples"))


def stats_text(stats: DataFrame) -> DataFrame:
    """``kind, text``: the statistics of each kind of font as lines, fonts in order, characters with their codes."""
    signs = F.array_join(F.transform("unknown", lambda u: F.concat(F.lit("\n    "), u["char"], F.lit(" (code "), u["code"].cast("string"), F.lit(")"))), "")
    line = F.concat(F.lit("  "), F.col("font"), F.lit(": "), F.col("n_chars").cast("string"), F.lit(" characters"), signs)
    lines = F.transform(F.array_sort(F.collect_list(F.struct("font", line.alias("line")))), lambda x: x["line"])  # a row per font
    return stats.groupBy("kind").agg(F.array_join(lines, "\n").alias("text"))


def font_usage(rows: DataFrame, top: int = 20) -> DataFrame:
    """The most used fonts by characters, with the number of runs."""
    return rows.where("font is not null").groupBy("font.name").agg(F.count("*").alias("n_runs"), F.sum(F.length("text")).alias("n_chars")).orderBy(F.desc("n_chars"), "name").limit(top)
