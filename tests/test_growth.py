"""What large tables need: no broadcast of all rows, no key that brings most rows to one task, bounded batches."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quillspark.functions import markup, normalize
from quillspark.operators import segments, structure
from quillspark.sources import rtf
from tests.test_functions import apply


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [1, 4, 5, 8, 203])
def test_boundary_pages_over_stretches(spark, monkeypatch, n):
    monkeypatch.setattr(structure, "STRETCH", 4)
    r = random.Random(n)
    rows = [(i, *(str(r.randrange(2)) if r.random() < 0.9 else "x" for _ in range(4))) for i in range(n)]
    got = structure.boundary_pages(spark.createDataFrame(rows, "row_idx int, vol_start string, vol_end string, img_start string, img_end string"))
    kept = [tuple(map(int, row[1:])) for row in rows if "x" not in row]
    assert {tuple(x) for x in got.collect()} == {(a[1], a[3]) for a, b in zip(kept, kept[1:]) if (a[1], a[3]) == (b[0], b[2])}
    assert "Join" not in plan(got)


def test_registry_is_broadcast(spark):
    docs = spark.createDataFrame([(i, [20] * (i % 2)) for i in range(9)], "i int, sizes array<int>")
    registry = spark.createDataFrame([("p", [20], 1)], "profile string, sizes array<int>, ord int")
    got = segments.match_profiles(docs, registry)
    assert "BroadcastHashJoin" in plan(got) and "SortMergeJoin" not in plan(got)
    assert sorted((r["i"], r["profile"]) for r in got.collect()) == [(i, "p" if i % 2 else None) for i in range(9)]


def test_statistics_decode_once(spark):
    runs = spark.createDataFrame([("d", i, "abz1z", {"id": 1, "name": n, "size": 12}) for i, n in enumerate(["Dedris-a", "Dedris-q", "Serif"])], "doc_id string, seq int, text string, font struct<id: int, name: string, size: int>")
    decoded = rtf.decode_runs(runs, {"Dedris-a": {"ab": "x", "a": "y"}})
    stats = rtf.decode_stats(decoded)
    assert len(re.findall(r"ArrowEvalPython", plan(stats).split("== Initial Plan ==")[0])) == 1
    got = {r["font"]: (r["kind"], r["n_runs"], r["n_chars"], [u["char"] for u in r["unknown"]], r["samples"]) for r in stats.collect()}
    assert got == {"Dedris-a": ("handled", 1, 5, ["1", "z"], []), "Dedris-q": ("unhandled", 1, 5, [], []), "Serif": ("other", 1, 5, [], ["abz1z"])}


def test_longest_sequences():
    table = {"a": "1", "ab": "2", "abcd": "3", ".": "4", "]": "5", "b-": "6", "": "7"}
    assert re.split(rtf.longest_first(table), "abcabcdb-].x")[1::2] == ["ab", "abcd", "b-", "]", "."] and rtf.longest_first({"": "x"}) == ""


def test_runs_come_in_small_batches():
    files = [("a", b"{\\rtf1 " + b"x\\par " * 8000 + b"}"), ("b", None), ("c", b"{\\rtf1 y}")]
    got = list(rtf.batches_of(iter(files), "v3"))
    assert sum(b.num_rows for b in got) == 16_001 and max(b.num_rows for b in got) <= rtf.OUT_ROWS


def test_contexts_by_places(spark):
    r = random.Random(5)
    texts = ["".join(r.choice("A.1ིིaab \n\r ") for _ in range(60)) for _ in range(400)] + ["", None]
    for near in (15, 3):
        pattern = re.compile("X{0,N}[0-9.A-Z][ཱ-྄]X{0,N}".replace("X", "[^\n\r\u0085  ]").replace("N", str(near)))
        assert apply(spark, lambda c, near=near: markup.suspicious_contexts(c, near), texts) == [None if t is None else pattern.findall(t) for t in texts]
    assert [markup.contexts_of("Aི", 15), apply(spark, markup.ascii_signs, ["ab<b!é", "", None])] == [["Aི"], [["!", "a", "b"], [], None]]


@pytest.mark.parametrize("f, most", [(markup.annotations, 1), (normalize.normalize_text, 3), (normalize.nfc, 3), (markup.line_markup, 3)])
def test_texts_are_not_made_again(spark, f, most):
    """How often the plan makes the text that a function takes."""
    df = spark.createDataFrame([("é {a,b}",)], "v string").select(f(F.reverse("v")).alias("o"))
    assert plan(df).count("reverse(") <= most
