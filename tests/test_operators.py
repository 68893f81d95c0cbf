import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.operators import joins, segments, structure
from quillspark.plans import tei
from quillspark.streaming import incremental


def test_size_class_rules(spark):
    rows = [("a", 18, 100, True), ("a", 24, 10, True), ("a", 10, 5, False), ("b", 20, 50, True), ("b", 30, 50, False), ("c", 40, 9, True)]
    counts = spark.createDataFrame(rows, "doc string, fs int, cnt long, on_first_page boolean")
    got = {(r["doc"], r["fs"]): r["class"] for r in segments.classify(counts, "doc", "A").collect()}
    assert got == {("a", 18): "regular", ("a", 24): "large", ("a", 10): "small", ("b", 20): "small", ("b", 30): "regular", ("c", 40): "regular"}


def test_running_start_modes(spark):
    rows = spark.createDataFrame([(1, k, p) for k, p in enumerate([10, 7, 3, 11, 1])], "vol int, ord int, pages long")
    starts = lambda mode: [r["page_start"] for r in structure.running_start(rows, ["vol"], ["ord"], "pages", 4, mode).orderBy("ord").collect()]
    assert starts("intended") == [4, 14, 21, 24, 35]
    want, s = [], 4
    for p in [10, 7, 3, 11, 1]:
        want.append(s)
        s = 2 * s - 1 + p
    assert starts("as_coded") == want


@pytest.mark.parametrize(
    "page, want, rule",
    [("<lb/>ཀ ༡༢༽ ཁ", "<lb/>ཀ M༡༢༽ ཁ", 1), ("<lb/>ཀཁགངཅ༄ཆ", "<lb/>ཀཁགངཅM༄ཆ", 2), ("<lb/>༄ཀ<lb/>ཁ༄", "<lb/>༄ཀ<lb/>ཁM༄", 2), ("<lb/>ཀ༈ཁ", "<lb/>ཀM༈ཁ", 3), ("<lb/>ཀ། ། །ཁ", "<lb/>ཀ། ། །Mཁ", 4), ("<lb/>༄ཀ", "<lb/>༄ཀ", 0)],
)
def test_milestone_rules(spark, page, want, rule):
    text, n = structure.place_milestone(F.lit(page), F.lit("M"))
    row = spark.range(1).select(text.alias("t"), n.alias("n")).first()
    assert (row["t"], row["n"]) == (want, rule)


def test_milestones_in_text(spark):
    docs = spark.createDataFrame([("d", 1, '<pb n="1"/>\n<lb/>ཀ༈ཁ<pb n="2"/>\n<lb/>ཀ')], "doc_id string, vol int, text string")
    out, unresolved = structure.milestones_in_text(docs, spark.createDataFrame([(1, 1), (1, 2)], "vol int, page int"))
    assert out.first()["text"] == '<pb n="1"/>\n<lb/>ཀ<milestone xml:id="P1_B01" unit="section"/>༈ཁ<pb n="2"/>\n<lb/>ཀ'
    assert [(r["page"], r["preview"]) for r in unresolved.collect()] == [(2, "\nཀ")]


def test_triage_and_title_page(spark):
    cases = spark.createDataFrame([(1, 5, "a\n༅b\nc"), (1, 6, "t\n\nu"), (1, 7, "a\nb\nc")], "vol int, end_page int, next_page_text string")
    fixed, review = structure.triage(cases)
    assert [(r["old_end_page"], r["new_end_page"]) for r in fixed.collect()] == [(5, 6)] and [r["end_page"] for r in review.collect()] == [7]


def test_page_index_last_file_wins(spark):
    rows = [(1, 1, 1, '<pb n="1"/><pb n="2"/>'), (1, 2, 2, '<tei:pb n="2"/><milestone xml:id="P2_B01" unit="section"/>')]
    pages, spans, marks = structure.page_index(spark.createDataFrame(rows, "vol int, file_order int, etext int, content string"))
    assert {(r["page"], r["etext"]) for r in pages.collect()} == {(1, 1), (2, 2)}
    assert marks.first()["milestone"] == "P2_B01" and spans.count() == 2


def test_range_lookup_and_zip(spark):
    points = spark.createDataFrame([(1, 5), (1, 12), (2, 5)], "g int, p int")
    ranges = spark.createDataFrame([(1, 1, 6, "a"), (1, 7, 10, "b")], "g int, s int, e int, name string")
    got = {(r["g"], r["p"]): r["name"] for r in joins.range_lookup(points, ranges, ["g"], "p", "s", "e").collect()}
    assert got == {(1, 5): "a", (1, 12): None, (2, 5): None}
    left, right = spark.range(5), spark.range(3).withColumnRenamed("id", "other")
    assert joins.zip_join(left, right, ["id"], ["other"]).count() == 3
    assert joins.zip_join(left, right, ["id"], ["other"], leftovers=True).count() == 5


def test_sized_text_pipeline(spark):
    docs = spark.createDataFrame([("x", 1, 1, "<fs:20>ཀ་ཁ་<fs:30>ག་ང་ZZZZཅ་"), ("y", 1, 2, "<fs:11>ཀ་"), ("z", 1, 3, "plainZZZZ")], "doc_id string, vol int, ord int, text string")
    registry = spark.createDataFrame([("profile001", [20, 30], 1, {30: "large"})], "profile string, sizes array<int>, ord int, classes map<int, string>")
    blanks = spark.createDataFrame([("z", 1)], "doc_id string, blanks int")
    out, issues = tei.sized_text_tei(docs, registry, blanks)
    body = {r["doc_id"]: (r["page_start"], r["body"]) for r in out.collect()}
    assert set(body) == {"x", "z"} and body["x"][0] == 6 and body["z"][0] == 8
    assert '<hi rend="head">' in body["x"][1] and [(r["doc_id"], r["code"]) for r in issues.collect()] == [("y", "NO_PROFILE")]


def test_streaming_files(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    (tmp_path / "in").mkdir()
    op = lambda b: b.select("path", F.sha2("content", 256).alias("sha256"))
    for n in range(2):
        (tmp_path / "in" / f"{n}.txt").write_text(str(n))
        incremental.run_available(incremental.file_stream(spark, src), op, out, ck)
    assert spark.read.parquet(out).count() == 2


def test_job_totals(spark):
    rows = spark.createDataFrame([("a", "1", True, None), ("a", "2", False, "e2"), ("a", "3", False, "e3")], "ie_id string, doc_id string, ok boolean, error string")
    r = tei.job_totals(rows).first()
    assert (r["success"], r["failed"], r["first_errors"]) == (1, 2, ["e2", "e3"])


def test_boundary_pages_over_all_rows(spark):
    rows = [(0, "1", "1", "1", "5"), (1, "1", "1", "5", "9"), (2, "1", "x", "9", "9"), (3, "1", "2", "10", "3"), (4, "2", "2", "3", "8")]
    outline = spark.createDataFrame(rows, "row_idx int, vol_start string, vol_end string, img_start string, img_end string")
    want = {(1, 5), (2, 3)}
    assert {tuple(r) for r in structure.boundary_pages(outline).collect()} == want
    one = outline.withColumn("g", F.lit(1))
    assert {tuple(r) for r in structure.boundary_pages(one, by=["g"]).collect()} == want


def test_positions_over_many_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    n = 300_000
    spark.range(n).select("id", (F.col("id") * 7919 % 1000).alias("k"), F.rand(3).alias("x")).repartition(8).write.parquet(path)
    rows = spark.read.parquet(path)
    for order in (["x"], ["k"]):  # the second with many ties
        got = joins.ranked(rows, order, [])
        assert got.agg(F.countDistinct("_rank"), F.min("_rank"), F.max("_rank")).first() == (n, 1, n)
        w = Window.partitionBy().orderBy("_rank")
        assert got.withColumn("before", F.lag(order[0]).over(w)).where(F.col("before") > F.col(order[0])).count() == 0
    same = joins.zip_join(rows.select("id", "x"), rows.select(F.col("id").alias("other"), F.col("x").alias("y")), ["x"], ["y"])
    assert same.count() == n and same.where("id <> other").count() == 0
    assert joins.ranked(rows.limit(0), ["x"], []).count() == 0


def test_spread_join_of_a_hot_key(spark):
    rows = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50 + 2).alias("k"), "id").unionByName(spark.range(3).select(F.lit(None).cast("long").alias("k"), "id"))
    table = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("most"))
    got = joins.spread_join(rows, table, ["k"], "n")
    want = rows.join(table.drop("n"), "k")
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and got.count() == want.count()
    assert joins.spread_join(rows, table, ["k"], "n", "left").count() == rows.count()


def test_as_coded_starts_that_leave_a_long(spark):
    rows = spark.createDataFrame([(1, k, 1) for k in range(80)] + [(2, k, 0) for k in range(80)], "vol int, ord int, pages long")
    got = {(r["vol"], r["ord"]): r["page_start"] for r in structure.running_start(rows, ["vol"], ["ord"], "pages", F.when(F.col("vol") == 1, 4).otherwise(1), "as_coded").collect()}
    s = 4
    for k in range(80):
        assert got[1, k] == (s if s < 2**63 else None) and got[2, k] == 1
        s = 2 * s - 1 + 1


def test_sizes_on_the_first_page(spark):
    text = "<fs:10>\u0f40ZZZZ\u0f41<fs:12>abZZZZ\u0f42<fs:14>\u0f43"
    got = {r["fs"]: (r["cnt"], r["on_first_page"]) for r in segments.size_counts(spark.createDataFrame([("d", text)], "doc string, text string"), "doc").collect()}
    assert got == {10: (2, True), 12: (1, False), 14: (1, False)}


def test_sized_files_to_tei(spark):
    rows = [("IE1", "VE1", "UT1_0001", 1, 1, "a.txt", "00", "<fs:20>\u0f40\u0f0b<fs:30>\u0f41\u0f0bZZZZ\u0f42\u0f08\u0f43\u0f0b"), ("IE1", "VE1", "UT1_0002", 1, 2, "b.txt", "01", "<fs:11>\u0f40\u0f0b"), ("IE1", "VE1", "UT1_0003", 1, 3, "c.txt", "02", "one & twoZZZZthree")]
    files = spark.createDataFrame(rows, "ie_id string, ve_id string, ut_id string, vol int, ord int, path string, sha256 string, text string")
    registry = spark.createDataFrame([("profile001", [20, 30], 1, {30: "large"})], "profile string, sizes array<int>, ord int, classes map<int, string>")
    titles = spark.createDataFrame([(1, 6, "Old", 1), (1, 6, "Title", 2)], "vol int, page int, title string, row_idx int")
    boundaries = spark.createDataFrame([(1, 7), (1, 8)], "vol int, page int")
    out, issues = tei.sized_files_tei(files, registry, titles, boundaries)
    text = {r["ut_id"]: r["content"] for r in out.collect()}
    assert set(text) == {"UT1_0001", "UT1_0003"}
    for xml in text.values():
        ET.fromstring(xml.encode())
    assert "<title>Title</title>" in text["UT1_0001"] and '<milestone xml:id="P7_B01" unit="section"/>\u0f08' in text["UT1_0001"]
    assert "<title>UT1_0003</title>" in text["UT1_0003"] and "one &amp; two" in text["UT1_0003"] and '<pb n="9"/>' in text["UT1_0003"]
    assert {(r["doc_id"], r["code"]) for r in issues.collect()} == {("UT1_0002", "NO_PROFILE"), ("UT1_0003", "MISSING_TITLE"), ("UT1_0003", "NO_PLACE_FOR_MILESTONE")}
