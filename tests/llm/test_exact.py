"""Operators with an exact brute-force version: codec, substring dedup, line dedup, fingerprints, packing, vectors."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers as tok
import pytest
import xxhash
from pyspark.sql import functions as F

from quillspark.llm import bpe, common, fingerprints, lines, packing, simhash, substrings, vectors

DATA = "/root/testdata/sf0.001"
ODD = [None, "", " ", "a", "\n\n", "é" * 50, "x" * 3000, "word " * 900, "The same text. " * 40, "The same text. " * 40]


def docs_of(spark, texts, **more):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("uid", F.lit("clash")).withColumn("anchor", F.lit(1)).repartition(3)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def clusters(n, near):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i in range(n):
        for j in range(i):
            if near(i, j):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# --- byte-level BPE


def test_codec_is_the_library_and_round_trips(spark):
    path = tok.path("byte_bpe_multi_50k.tiktoken")
    enc = bpe.encoder(path, tok.PATTERN)
    r = random.Random(3)
    texts = ODD + ["".join(r.choice("abc é中٣ \n\t'.,!ſ<|>") for _ in range(r.randrange(300))) for _ in range(60)] + ["<|endoftext|> 'll don't", "ab cd " * 30_000]
    got = by_id(bpe.bpe_round_trip(docs_of(spark, texts), path, tok.PATTERN, with_ids=True))
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        row = got[i]
        assert row["ids"] == ids and row["n_tokens"] == len(ids) and row["round_trip"]
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()


def test_codec_cuts_only_at_safe_boundaries():
    enc = bpe.encoder(tok.path("byte_bpe_multi_50k.tiktoken"), tok.PATTERN)
    r = random.Random(4)
    for _ in range(200):
        t = "".join(r.choice("ab  .'s1\né") for _ in range(200))
        assert "".join(bpe.parts(t, 5)) == t
        assert bpe.encode(enc, tok.PATTERN, t, 5).tolist() == enc.encode_ordinary(t)
    assert list(bpe.parts("", 5)) == [""]


def test_codec_of_long_runs():
    enc = bpe.encoder(tok.path("byte_bpe_multi_50k.tiktoken"), tok.PATTERN)
    r = random.Random(8)
    for t in (" " * 400_000, "x" + "\n" * 400_000 + "y", "a" * 300_000, "." * 300_000):
        assert enc.decode_bytes(bpe.encode(enc, tok.PATTERN, t).tolist()) == t.encode()
    for _ in range(200):
        t = "".join(r.choice("ab  .'s1\né中\t") for _ in range(150))
        assert bpe.by_pieces(enc, tok.PATTERN, t) == enc.encode_ordinary(t)


def test_codec_of_an_empty_table(spark):
    path = tok.path("byte_bpe_multi_50k.tiktoken")
    assert bpe.bpe_round_trip(docs_of(spark, ["a"]).limit(0), path, tok.PATTERN).count() == 0


# --- exact substrings


def brute_substrings(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[s : s + length] for b in raw for s in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                gone[s : s + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("seed, crowd", [(1, 1024), (2, 2), (3, 1)])
def test_substrings_against_brute_force(spark, seed, crowd):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abé") for _ in range(r.randint(1, 6)))
    shared = [" ".join(word() for _ in range(30)) for _ in range(4)]
    texts = ODD + ["aaaa" * 60, "ab" * 77]
    for _ in range(40):
        parts = [" ".join(word() for _ in range(r.randint(0, 15))) for _ in range(3)] + r.sample(shared, r.randint(0, 2))
        r.shuffle(parts)
        texts.append(" ".join(parts))
    got = by_id(substrings.dedup(docs_of(spark, texts), length=40, gram=12, crowd=crowd))
    want = brute_substrings(texts, 40)
    for i, w in enumerate(want):
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == w, (i, texts[i])


def test_substrings_of_long_texts_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BUFFER", 500)
    r = random.Random(7)
    long = "".join(r.choice("abcdef") for _ in range(5000))
    texts = [long, long[700:1900], "z" + long[2000:2100]]
    got = by_id(substrings.dedup(docs_of(spark, texts), length=40, gram=12))
    for i, w in enumerate(brute_substrings(texts, 40)):
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == w
    twice = spark.createDataFrame([(1, long), (1, long), (None, "short")], "doc_id long, text string")
    rows = substrings.dedup(twice, length=40, gram=12).collect()
    assert sorted(x["n_removed"] for x in rows) == [0, 5000, 5000]
    assert substrings.dedup(twice.limit(0), length=40, gram=12).count() == 0


def test_substrings_of_a_crowded_anchor(spark):
    r = random.Random(9)
    licence = "".join(r.choice("abcdef ") for _ in range(70))
    texts = ["".join(r.choice("abcdef ") for _ in range(r.randint(5, 60))) + licence + "".join(r.choice("abcdef ") for _ in range(r.randint(5, 60))) for _ in range(80)]
    texts += ["a" * 500, "a" * 37, "ab" * 300] + texts[:5]
    got = by_id(substrings.dedup(docs_of(spark, texts), length=40, gram=12, crowd=7))
    for i, w in enumerate(brute_substrings(texts, 40)):
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == w, (i, texts[i])


def test_windows_with_equal_hashes_are_told_apart(monkeypatch):
    r = random.Random(5)
    raw = bytes(r.choice(b"ab") for _ in range(600))
    span = np.full(6, 100)
    start, skip, group = np.arange(6) * 100, np.full(6, 50), np.zeros(6, np.int64)
    plain = substrings.Hashes.of
    monkeypatch.setattr(substrings.Hashes, "of", lambda self, s, n: plain(self, s, n) & np.uint64(3))
    run, place, hit, _ = substrings.repeated_windows(raw, start, span, skip, group, 8)
    seen = Counter((p, raw[100 * k + p : 100 * k + p + 8]) for k in range(6) for p in range(93))
    assert hit.any() and not hit.all()
    assert all(h == (seen[p, raw[100 * k + p : 100 * k + p + 8]] > 1) for k, p, h in zip(run.tolist(), place.tolist(), hit.tolist()))


def test_ranges_across_blocks_are_compared_by_bytes(spark):
    held = spark.createDataFrame([(1, 10, 0, 20, bytearray(b"0123456789abcdefghij")), (1, 11, 5, 20, bytearray(b"0123456789abcdefghiX")), (1, 12, 0, 20, bytearray(b"0123456789abcdefghiX"))], "anchor long, uid long, start int, span int, bytes binary")
    h = np.array([7, 8], np.uint64).tobytes()
    refs = np.array([[0, 0], [0, 12]], "<i4").tobytes()
    rows = [(None, None, None, None, 1, 0, b, bytearray(h), bytearray(refs), bytearray(np.array([[uid, start]], np.int64).tobytes())) for b, (uid, start) in enumerate([(10, 0), (11, 5), (12, 0)])]
    judged = spark.createDataFrame(rows, substrings.JUDGED)
    marks = {}
    for m in substrings.across_blocks(judged, held, 8).collect():
        a, b = np.frombuffer(bytes(m["covered"]), "<i4")
        marks.setdefault((m["uid"], m["start"]), set()).update(range(a, b))
    assert marks[11, 5] == marks[12, 0] and max(marks[11, 5]) == 19 and 0 in marks[10, 0] and 19 not in marks[10, 0]


def test_suffix_sort_orders_suffixes():
    r = np.random.default_rng(5)
    raw = r.integers(97, 99, 400).astype(np.uint8)
    h = substrings.Hashes(raw)
    suffix = r.permutation(300)
    group = np.sort(r.integers(0, 6, 300))
    order = substrings.suffix_sort(raw, h, suffix, group, 60)
    text = raw.tobytes()
    for g in range(6):
        got = [text[s : s + 60] for s in suffix[order[group == g]]]
        assert got == sorted(got) and sorted(suffix[order[group == g]]) == sorted(suffix[group == g])


# --- lines


def brute_lines(texts, k):
    seen, out = {}, []
    rows = [(i, [x for x in (t or "").split("\n") if x.strip(" \t\r\f\v")]) for i, t in enumerate(texts)]
    for i, ls in rows:
        for p in range(len(ls) - k + 1):
            seen.setdefault(tuple(ls[p : p + k]), (i, p))
    for (i, ls), t in zip(rows, texts):
        starts = [(p, k) for p in range(len(ls) - k + 1) if seen[tuple(ls[p : p + k])] != (i, p)]
        out.append(t if t is None else lines.keep_lines(t, starts)[0])
    return out


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_lines_against_brute_force(spark, k):
    r = random.Random(k)
    texts = [None, "", "\n \n", "a", "a\na\na\na\na\na\na"] + ["\n".join(r.choice(["a", "b", "c", "d", "", " "]) for _ in range(r.randrange(12))) for _ in range(60)]
    got = by_id(lines.without_copies(docs_of(spark, texts), k))
    assert [got[i]["text"] for i in range(len(texts))] == brute_lines(texts, k)
    assert got[3]["uid"] == "clash"


def test_line_ranks_order_suffixes(spark):
    r = random.Random(7)
    texts = ["\n".join(r.choice("ab") for _ in range(r.randint(1, 25))) for _ in range(30)] + ["x\ny\nz\nw\nv"] * 2
    docs = spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "doc long, tie int, text string")
    split = [t.split("\n") for t in texts]
    found = lines.intervals(docs, 1)
    assert [n for n, _ in found] == [2**k for k in range(len(found))]
    first = {(x["doc"], x["p"]): x["rank"] for x in found[0][1].collect()}
    alphabet = {split[d][p]: rank for (d, p), rank in first.items()}
    for n, rows in found:
        rows = rows.collect()
        count = Counter(tuple(t[p : p + n]) for t in split for p in range(len(t) - n + 1))
        assert {(x["doc"], x["p"]) for x in rows} == {(d, p) for d, t in enumerate(split) for p in range(len(t) - n + 1) if count[tuple(t[p : p + n])] > 1}
        keys = {}
        for x in rows:
            keys.setdefault(x["rank"], set()).add(tuple(alphabet[c] for c in split[x["doc"]][x["p"] : x["p"] + n]))
        assert all(len(v) == 1 for v in keys.values())
        ordered = [next(iter(keys[k])) for k in sorted(keys)]
        assert ordered == sorted(ordered)
    longest = {}
    for x in lines.later_starts(docs, 1).collect():
        longest[x["doc"], x["p"]] = x["length"]
    assert longest[31, 0] == 4 and (30, 0) not in longest


def test_one_line_in_half_of_all_documents(spark):
    texts = [f"Copyright\nown {i}\nlast {i % 7}" if i % 2 else f"a {i}\nb {i}" for i in range(4000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(lines.without_copies(docs, 1))
    want = brute_lines(texts, 1)
    assert all(got[i]["text"] == w for i, w in enumerate(want))


def test_lines_query_and_odd_tables(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{DATA}/documents.parquet'")
    want = con.execute(lines.OP3_SQL).df().sort_values("doc_id", ignore_index=True)
    got = lines.op3_line_dedup(spark, DATA).toPandas().sort_values("doc_id", ignore_index=True)
    assert (got.astype(str) == want[got.columns].astype(str)).all().all()
    rows = spark.createDataFrame([(1, "a\nb"), (1, "a\nb"), (None, "c\nd"), (2, "c\nd")], "doc_id long, text string")
    assert sorted(r["text"] for r in lines.without_copies(rows).collect()) == ["", "a\nb", "a\nb", "c\nd"]
    assert lines.dedup_lines(rows.limit(0)).count() == 0
    clash = lines.without_copies(rows.withColumn("starts", F.lit(1)).withColumn("tie", F.lit("t")).withColumn("row", F.lit("r")))
    assert {(r["starts"], r["tie"], r["row"]) for r in clash.collect()} == {(1, "t", "r")}


# --- fingerprints of documents


def term_fingerprint(text):
    import re

    words = re.split(r"[\W_]+", text.lower())
    ones, total = [0] * 64, 0
    for i, a in enumerate(words):
        w = min(max(len(a), 1), 16)
        h = xxhash.xxh64_intdigest(a.encode(), 42)
        if i + 1 < len(words):
            h = xxhash.xxh64_intdigest(words[i + 1].encode(), h)
        total += w
        for b in range(64):
            ones[b] += w * (h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > total)


def test_document_fingerprints(spark):
    texts = [None, "", "one", "Some words, and some more words here", "x" * 500, "same text here", "same text here"] + [f"line {i} of words {i * 7}" for i in range(20)]
    got = by_id(simhash.edited_fingerprints(docs_of(spark, texts)))
    for i, t in enumerate(texts):
        t, nxt = t or "", texts[(i + 1) % len(texts)] or ""
        edited = t[: len(t) - len(t) // 4] + nxt[: len(t) // 4]
        row = got[i]
        assert row["n_chars"] == len(t) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert int(row["fingerprint"], 16) == term_fingerprint(t) and int(row["edited_fingerprint"], 16) == term_fingerprint(edited)
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
    assert got[5]["fingerprint"] == got[6]["fingerprint"] and got[5]["near_next"] == 1
    fps = [int(got[i]["fingerprint"], 16) for i in range(len(texts))]
    assert [got[i]["n_near"] for i in (0, 1, 26)] == [sum((fps[0] ^ x).bit_count() <= simhash.RADIUS for x in fps) - 1, None, None]


def test_document_fingerprints_of_odd_tables(spark):
    one = spark.createDataFrame([(5, "only one text")], "doc_id long, text string")
    row = simhash.edited_fingerprints(one).first()
    assert row["near_next"] == 1
    twice = spark.createDataFrame([(5, "a b"), (5, "a b"), (None, "c"), (5, "d")], "doc_id long, text string")
    assert simhash.edited_fingerprints(twice).count() == 4
    assert simhash.edited_fingerprints(one.limit(0)).count() == 0


def test_within_radius(spark):
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(12)]
    fps = base + [b ^ sum(1 << k for k in r.sample(range(64), n)) for b in base for n in (1, 2, 3, 4, 5)]
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    table = spark.createDataFrame([(x, 2) for x in signed], "fp long, weight int")
    asked = spark.createDataFrame([(x,) for x in signed[:12]], "q long")
    got = Counter((r["q"], r["fp"]) for r in simhash.within_radius(asked, table).collect())
    want = {(a, b) for a in signed[:12] for b in signed if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert set(got) == want and max(got.values()) == 1


# --- SimHash near-duplicates


def naive_simhash(text):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_by_definition():
    for t in ODD + ["One two THREE four five É", "a b c", "a b c\x0bd\x1ce f g"]:
        assert fingerprints.simhash(t) == naive_simhash(t)


@pytest.mark.parametrize("crowd, scheme", [(4096, 0), (3, 0), (4096, 1)])
def test_near_components_against_brute_force(spark, crowd, scheme):
    r = random.Random(crowd)
    fps = [0, 0, (1 << 64) - 1]
    for _ in range(60):
        c = r.getrandbits(64)
        fps += [c ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 7))) for _ in range(r.randint(1, 9))]
    fps += [sum(1 << k for k in r.sample(range(10), r.randint(0, 6))) for _ in range(60)]
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    table = spark.createDataFrame([(i, x) for i, x in enumerate(signed)], "doc_id long, fp long")
    got = by_id(fingerprints.near_components(table, crowd, fingerprints.SCHEMES[scheme]))
    want = clusters(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    assert [got[i]["component_id"] for i in range(len(fps))] == want


@pytest.mark.parametrize("blocks", fingerprints.SCHEMES)
def test_every_close_pair_meets(blocks):
    assert sum(b[1] for b in blocks) == 64 and sum(b[3] + 1 for b in blocks) == fingerprints.THRESHOLD + 1
    r = random.Random(9)
    xs = [r.getrandbits(64) for _ in range(300)]
    ys = [x ^ sum(1 << k for k in r.sample(range(64), 4)) for x in xs]
    met = np.zeros(300, bool)
    for first, bits, coded, t in blocks:
        part = lambda v: (np.array(v, np.uint64) >> np.uint64(first)) & np.uint64((1 << bits) - 1)
        home, _ = fingerprints.anchors(part(xs), bits, coded, t)
        if coded:
            assert (fingerprints.syndrome(home, coded) == 0).all() and (np.bitwise_count(home ^ part(xs).astype(np.uint32)) <= 1).all()
        _, reach = fingerprints.anchors(part(ys), bits, coded, t)
        n = 0
        for rows, anchor in reach:
            met[rows] |= home[rows] == anchor
            n += len(rows)
        assert abs(n / 300 - fingerprints.replicas(bits, coded, t)) < 0.1 * n / 300
    assert met.all()


def test_schemes_follow_the_count():
    assert fingerprints.blocks_for(1000) == fingerprints.SCHEMES[0]
    assert fingerprints.blocks_for(10**11) == fingerprints.SCHEMES[1]


def test_one_of_each_and_null_ids(spark):
    rows = spark.createDataFrame([(3, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (None, "other words in this text"), (4, None), (5, "")], "doc_id long, text string")
    kept = {(r["doc_id"], r["text"]) for r in fingerprints.one_of_each(rows).collect()}
    assert len(kept) == fingerprints.one_of_each(rows).count() == 3
    clash = fingerprints.one_of_each(rows.withColumn("uid", F.lit("a")).withColumn("row", F.lit("b")))
    assert clash.columns == ["doc_id", "text", "uid", "row"] and {(x["uid"], x["row"]) for x in clash.collect()} == {("a", "b")}
    assert (1, "a b c d e") in kept and (None, "other words in this text") in kept
    assert fingerprints.one_of_each(rows.limit(0)).count() == 0


# --- packing


def test_packing(spark):
    from tokenizers import Tokenizer

    path = tok.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    r = random.Random(2)
    texts = ODD + ["".join(r.choice("aAéÉß .,'|!\n\t1٣Σςİıſ中 ́") for _ in range(r.randrange(80))) for _ in range(300)] + ["two words " * 5000]
    texts += ["a<|endoftext|>b <|startoftext|> c", "<|endoftext|><|ENDOFTEXT|>", "x <|endoftext |> y"]
    rows = packing.pack_documents(docs_of(spark, texts), path).collect()
    ids = {i: whole.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(texts)}
    place = {}
    for x in rows:
        part = ids[x["doc_id"]][x["start"] : x["start"] + x["length"]]
        assert x["start"] == 4096 * x["piece"] and x["length"] == len(part)
        assert x["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
        place.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    assert Counter(x["doc_id"] for x in rows) == {i: -(-len(v) // 4096) for i, v in ids.items()}
    for s in place.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:])) and sum(s[-1]) <= 4096
    assert len(place) == -(-sum(map(len, ids.values())) // 4096)


def test_packing_names_of_special_tokens_as_text():
    from tokenizers import Tokenizer

    path = tok.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    text = "a<|endoftext|>b"
    made = packing.WordEncoder.of(path, plain_names=True).encode([text])[0]
    assert np.frombuffer(made, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_packing_in_rounds_and_odd_tables(spark):
    r = random.Random(3)
    rows = [(i, 0, 0, r.choice([1, 7, 100, 900, 2049, 4096, r.randint(1, 4096)]), 0) for i in range(900)] + [(None, 0, 0, 5, 0)] + [(1, 0, 0, 5, 0)] * 300
    table = spark.createDataFrame(rows, packing.PIECES).withColumn("pid", F.lit("clash")).withColumn("settled", F.lit(1))
    got = packing.pack(table, block=100).collect()
    fill = Counter()
    for x in got:
        fill[x["sequence_id"]] += x["length"]
    assert len(got) == 1201 and max(fill.values()) <= 4096 and sum(x["doc_id"] is None for x in got) == 1
    assert all(x["pid"] == "clash" and x["settled"] == 1 for x in got)
    large = sum(x[3] > 2048 for x in rows)
    assert len(fill) <= max(large, -(-sum(fill.values()) // 4096)) * 1.06 + 2
    assert packing.pack(table.limit(0)).count() == 0


def fewest_bins(length, capacity):
    """By exhaustive search with the first open bins in order."""
    best = len(length)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best and k < len(length):
            return
        if k == len(length):
            best = min(best, len(rooms))
            return
        for b in {room: b for b, room in enumerate(rooms) if room >= length[k]}.values():
            place(k + 1, rooms[:b] + [rooms[b] - length[k]] + rooms[b + 1 :])
        place(k + 1, rooms + [capacity - length[k]])

    place(0, [])
    return best


def test_lower_bound_and_small_packings():
    r = random.Random(6)
    for _ in range(60):
        length = sorted((r.randint(1, 100) for _ in range(r.randint(1, 9))), reverse=True)
        best = fewest_bins(length, 100)
        assert packing.least_bins(length, 100) <= best <= len(packing.evolve(length, 100, 1)[0]) <= best + 1
    assert packing.least_bins([], 100) == 0


def test_islands_beat_best_fit_decreasing(spark):
    r = random.Random(1)
    length = []
    while len(length) < 600:
        a = r.randint(900, 1800)
        b = r.randint(900, min(1800, 4096 - a - 900))
        length += [a, b, 4096 - a - b]
    table = spark.createDataFrame([(i, 0, 0, n, 0) for i, n in enumerate(length)], packing.PIECES)
    report = {}
    rows = packing.pack(table, report=report).collect()
    down = packing.packed(sorted(range(len(length)), key=lambda i: -length[i]), length, 4096)
    assert report == {"blocks": 1, "evolved": 1}
    assert 200 <= len({x["sequence_id"] for x in rows}) < len(down) - 3
    again = packing.pack(table).collect()
    assert len({x["sequence_id"] for x in again}) == len({x["sequence_id"] for x in rows})
    alone = packing.pack(spark.createDataFrame([(i, 0, 0, 1000, 0) for i in range(40)], packing.PIECES), report=report)
    assert alone.select("sequence_id").distinct().count() == 10 and report["evolved"] == 0


# --- vectors


def test_vectors_against_brute_force(spark):
    r = np.random.default_rng(4)
    base = r.standard_normal((60, 16))
    x = np.concatenate((base, base[:30] + 0.15 * r.standard_normal((30, 16)), np.repeat(base[:1], 5, 0), base[5] + 0.05 * r.standard_normal((40, 16)), 3 * base[:2])).astype(np.float32)
    label = [int(v) for v in r.integers(0, 2, 60)]
    label = label + label[:30] + [label[0]] * 5 + [label[5]] * 40 + label[:2]
    rows = [(i, v.tolist(), k) for i, (v, k) in enumerate(zip(x, label))]
    odd = [(900, None, 1), (901, [], 1), (902, [0.0] * 16, 1), (903, [1.0, None] * 8, 1), (904, [float("nan")] * 16, 1), (905, x[0].tolist(), None), (906, [1.0, 2.0], 1), (907, [2.0, 4.0], 1)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, label int").withColumn("cid", F.lit("clash"))
    unit = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    near = lambda i, j: label[i] == label[j] and float(unit[i] @ unit[j]) >= 0.93
    want = clusters(len(rows), near)
    n = [sum(near(i, j) for j in range(len(rows)) if j != i) for i in range(len(rows))]
    for crowd in (2048, 8):
        got = {q["vec_id"]: q for q in vectors.near_vectors(table, crowd=crowd).collect()}
        assert [got[i]["component_id"] for i in range(len(rows))] == want
        assert [got[i]["n_links"] for i in range(len(rows))] == n
        assert all(got[i]["kept"] == (want[i] == i) for i in range(len(rows)))
        assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(900, 906))
        assert got[907]["component_id"] == 906 and got[906]["n_links"] == 1
    assert vectors.near_vectors(table.limit(0)).count() == 0


def test_vector_recall_on_hard_pairs(spark):
    r = np.random.default_rng(6)
    a = r.standard_normal((600, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = r.standard_normal((600, 64))
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.935 * a + (1 - 0.935**2) ** 0.5 * side
    rows = [(i, v.tolist(), 0) for i, v in enumerate(np.concatenate((a, b)))]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert got.where("n_links > 0").count() >= 0.9 * 1200


@pytest.mark.parametrize("crowd", [2048, 8])
def test_vector_recall_with_a_common_direction(spark, crowd):
    r = np.random.default_rng(6)
    x = np.sqrt(0.8) * np.eye(64)[0] + np.sqrt(0.2 / 63) * r.standard_normal((600, 64)) * (np.arange(64) > 0)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = np.roll(x, 1, axis=0)
    side -= (side * x).sum(1, keepdims=True) * x
    y = 0.935 * x + (1 - 0.935**2) ** 0.5 * side / np.linalg.norm(side, axis=1, keepdims=True)
    every = np.concatenate((x, y))
    want = (every @ every.T >= 0.93).sum(1) - 1
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(every)], "vec_id long, embedding array<double>, label int")
    got = {q["vec_id"]: q["n_links"] for q in vectors.near_vectors(table, crowd=crowd).collect()}
    assert all(got[i] <= n for i, n in enumerate(want)) and sum(got.values()) >= 0.97 * want.sum()


def test_components(spark):
    edges = [(1, 2), (2, 3), (7, 7), (9, 8), (3, 1), (10, 11), (11, 12), (12, 13), (13, 14)] + [(100, k) for k in range(101, 160)]
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, **{k: 10 for k in range(10, 15)}, **{k: 100 for k in range(100, 160)}}
