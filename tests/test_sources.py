import xml.etree.ElementTree as ET

from pyspark.sql import functions as F

from quillspark.functions import markup
from quillspark.plans import tei
from quillspark.sources import decoders, files, markers, rtf, sinks

MARKED = "junk\n[1a]\n[1b]\n[1b.1]{D1}ཀ་ཁ། (ག,ང)\n[1b.2] {D1-1}#ཅ\nloose\n\n[2a.1]ཆ"


def unit(spark, content, **more):
    row = {"ie_id": "IE1", "ve_id": "VE1", "ut_id": "UT1_0001", "vol_num": 1, "path": "a.txt", "sha256": "00", "content": content} | more
    return spark.createDataFrame([row])


def test_marked_text(spark):
    lines = markers.marked_lines(spark.createDataFrame([("d", MARKED)], "doc_id string, content string"))
    pages = [(p["folio"], len(p["lines"])) for p in markers.pages(lines).orderBy("page_seq").collect()]
    assert pages == [("1a", 0), ("1b", 3), ("2a", 1)]
    assert [(m["id"], m["folio"], m["line"]) for m in markers.milestones(lines).orderBy("seq", "pos").collect()] == [("D1", "1b", "1"), ("D1-1", "1b", "2")]


def test_marked_text_to_tei(spark):
    docs, marks = tei.marked_text_tei(unit(spark, MARKED))
    text = docs.first()["content"]
    ET.fromstring(text.encode())
    assert '<pb n="1a"/>' in text and '<milestone xml:id="D1" unit="section"/>' in text and "<corr>" in text and "#" not in text
    assert [(m["id"], m["end_id"]) for m in marks.orderBy("seq").collect()] == [("D1", "D1-1"), ("D1-1", "")]
    rows = sinks.milestone_outline(marks).orderBy("vol_num", "seq").collect()
    assert [r["cells"][5] for r in rows] == ["V", "T", "T"] and all(len(r["cells"]) == 17 for r in rows)


DIVIDED = "Title = A = B\nAuthor= C\nstray\n#div1 One\nbody 1\n\nbody 2 #div2 Two\nx\n#div3 Deep\ny\n#div1 Last\nz"


def test_divided_text(spark):
    docs = spark.createDataFrame([("d", DIVIDED)], "doc_id string, content string")
    assert markers.metadata(docs).first()["meta"] == {"Title": "A = B", "Author": "C"}
    divs = [(d["level"], d["title"], d["content"]) for d in markers.divisions(docs).orderBy("seq").collect()]
    assert divs == [(1, "One", "body 1\nbody 2"), (2, "Two", "x"), (3, "Deep", "y"), (1, "Last", "z")]


def test_divided_text_to_tei(spark):
    docs, ends = tei.divided_text_tei(unit(spark, DIVIDED))
    root = ET.fromstring(docs.first()["content"].encode())
    ns = "{http://www.tei-c.org/ns/1.0}"
    body = root.find(f".//{ns}body")
    tops = body.findall(f"{ns}div")
    assert [t.find(f"{ns}head").text for t in tops] == ["One", "Last"]
    assert tops[0].find(f"{ns}div/{ns}div/{ns}head").text == "Deep"
    rows = [(r["start_id"], r["end_id"]) for r in ends.orderBy("seq").collect()]
    assert rows == [("1#div1_0001", "1#div1_0004"), ("1#div2_0002", "1#div1_0004"), ("1#div1_0004", "")]
    assert [c["cells"][1:7] for c in sinks.div_outline(ends).orderBy("seq").collect()][0] == ["X", "", "", "", "T", "One"]


def test_malformed_division(spark):
    docs = spark.createDataFrame([("d", "#div1 A\na\n#divx\nb\n#div2 C\nc")], "doc_id string, content string")
    assert [(d["title"], d["content"]) for d in markers.divisions(docs).orderBy("seq").collect()] == [("A", "a\nb"), ("C", "c")]
    assert markers.divisions(docs, "as_coded").count() == 3


RTF3 = r"""{\rtf1\ansi{\fonttbl{\f0\fnil{\*\panose 02}Times;}{\f45\fnil{\*\panose 02}Dedris-a;}}{\info{\author x}}
\pard\ltrch\loch\f45\fs36 ab\{\hich\f0 c\par {\fs18 d\u3904?e}\line \'e9 f}"""


def parsed(data, dialect):
    return [(t, x, s) for t, x, _, _, s, _, _ in rtf.parse(data, dialect)]


def test_rtf_v3():
    rows = list(rtf.parse(RTF3, "v3"))
    assert [(r[0], r[1]) for r in rows] == [(None, "ab"), (None, "{c"), ("par_break", None), (None, "dཀe"), ("line_break", None), (None, "é f")]
    assert rows[0][2:5] == (45, "Dedris-a", 18) and rows[3][4] == 9
    assert rtf.sniff(RTF3) == "complex" and all(0 <= r[5] <= r[6] for r in rows)


def test_rtf_simple_dialects():
    data = r"{\rtf1{\fonttbl{\f1\fnil Tib;}}\f1\fs24 a\u3904?b  {\f1 c}\pard d\par e}"
    v1, v2 = parsed(data, "v1"), parsed(data, "v2")
    assert "".join(x for _, x, _ in v2).replace(" ", "") == "aཀbcd\ne"
    assert "\nd" in "".join(x for _, x, _ in v1)
    assert rtf.font_table(data, "v1") == {1: "Tib"}
    assert parsed("}}{", "v2") == [] and parsed("", "v3") == []
    assert parsed(r"{\u-10187?\u-8976?}", "v3") == [(None, "\U0001d4f0", 12)]


def test_rtf_runs_and_decoding(spark):
    src = spark.createDataFrame([("a", bytearray(RTF3.encode())), ("b", None)], "path string, content binary")
    rows = rtf.runs(src)
    assert rows.where("doc_id = 'b'").count() == 0
    got = rtf.decode_runs(rows, {"Dedris-a": {"ab": "ཀ", "a": "x"}}).orderBy("seq").collect()
    assert got[0]["text"] == "ཀ"
    body = tei.runs_tei_body(rows).first()["body"]
    assert "<lb/>" in body


def test_files_and_sinks(spark, tmp_path):
    base = tmp_path / "IE9" / "IE9" / "toprocess"
    for vol, name in (("IE9-VE10", "b.txt"), ("IE9-VE9", "a10.txt"), ("IE9-VE9", "a9.txt")):
        (base / vol).mkdir(parents=True, exist_ok=True)
        (base / vol / name).write_text(name)
    found = files.units(files.collections(files.text_files(spark, str(tmp_path))))
    assert [(r["ve_id"], r["vol_num"]) for r in files.volumes(found).orderBy("vol_num").collect()] == [("VE9", 1), ("VE10", 2)]
    assert sorted(r["ut_id"] for r in found.collect()) == ["UT10_0001", "UT9_0001", "UT9_0002"]
    assert {r["file_name"]: r["pos"] for r in found.where("ve_id = 'VE9'").collect()} == {"a9.txt": 1, "a10.txt": 2}
    wrote = sinks.write_files(found.select(F.concat("ut_id", F.lit(".xml")).alias("path"), "content"), (tmp_path / "out").as_uri())
    assert wrote.count() == 3 and (tmp_path / "out" / "UT9_0001.xml").read_text() == "a9.txt"
    assert sinks.csv_text(["Position", "Position"], [["a,b", ""]]) == 'Position,Position\r\n"a,b",\r\n'
    assert files.outline(spark, str(tmp_path / "none.csv")).count() == 0
    missing = files.digest_or_missing(spark.createDataFrame([("nowhere",)], "path string"), files.binary_files(spark, str(base)))
    assert missing.first()["sha256"] == "FILE_NOT_FOUND"


def test_toc(spark):
    lines = [" ༡༽ ཀ་ཁ་་་་་༡༢ ", "-- page 1 --", "༢༽ no leader", "༣ [[F11(]]x[[F1 ]]   y་་[[F13]]༤་་༩"]
    rows = spark.createDataFrame([("f", x) for x in lines], "folder string, line string")
    assert [tuple(r) for r in files.toc_rows(rows).collect()] == [("f", "1", "ཀ་ཁ", "12"), ("f", "2", "no leader", ""), ("f", "3", "༼x y", "34")]


def test_decoded_files(spark):
    def decoder(raw, regions):
        if raw == b"bad":
            raise ValueError("no")
        for page in raw.decode().split("|"):
            yield [page] if regions is None else [f"{page}{k}" for k in range(len(regions))]

    src = spark.createDataFrame([("a", bytearray(b"x\n\ny|z")), ("b", bytearray(b"bad")), ("c", None), ("d", bytearray(b"q")), ("single/e", bytearray(b"r")), ("f", bytearray(b"s"))], "path string, content binary")
    text, issues = decoders.decode_files(src, decoder, decoders.REGIONS, single_page="^single/", denied=["d", "f"], single_files=["f"])
    got = {r["path"]: r["text"] for r in text.collect()}
    assert got == {"a": "\nZZZZ\nx\ny0\nZZZZ\nx\ny1\nZZZZ\nx\ny2\nZZZZ\nz0\nZZZZ\nz1\nZZZZ\nz2", "b": None, "c": None, "d": None, "single/e": "\nZZZZ\nr", "f": "\nZZZZ\ns"}
    assert {(r["path"], r["code"]) for r in issues.collect()} == {("b", "NOT_DECODED"), ("c", "NO_CONTENT")}


def test_rtf_to_tei(spark):
    data = r"{\rtf1\ansi{\fonttbl{\f0\fnil Tib;}}\f0\fs24 \u3904? \u3905?\par {\fs48 \u3906?}\par \u3904?<x>}"
    src = spark.createDataFrame([("IE1", "VE1", "UT1", "a.rtf", "00", bytearray(data.encode())), ("IE1", "VE1", "UT2", "b.rtf", "00", None)], "ie_id string, ve_id string, ut_id string, path string, sha256 string, content binary")
    for dialect in ("v2", "v3"):
        docs, issues = tei.rtf_tei(src, dialect)
        text = {r["ut_id"]: r["content"] for r in docs.collect()}
        for xml in text.values():
            ET.fromstring(xml.encode())
        assert '<hi rend="head">ག</hi>' in text["UT1"] and "<lb/>" in text["UT1"] and "&lt;x&gt;" in text["UT1"]
        assert [(r["doc_id"], r["code"]) for r in issues.collect()] == [("UT2", "NO_CONTENT")]


def test_colour_table():
    assert rtf.colour_table(r"{\rtf1{\colortbl;\red255\green0\blue1;\red3\green4\blue5;}x}") == [None, (255, 0, 1), (3, 4, 5)]
    assert rtf.colour_table("{x}") == []


def test_font_statistics(spark):
    rows = [("d", 0, "ab?", "Dedris-a"), ("d", 1, "1. x", "Times"), ("d", 2, "q", "Dedris-z"), ("e", 0, "?#", "Dedris-a")]
    runs = spark.createDataFrame([(d, s, t, (1, f, 12)) for d, s, t, f in rows], "doc_id string, seq int, text string, font struct<id: int, name: string, size: int>")
    stats = rtf.decode_stats(rtf.decode_runs(runs, {"Dedris-a": {"a": "ཀ", "b": "ཁ"}}))
    got = {r["font"]: (r["kind"], r["n_runs"], r["n_chars"], [(u["code"], u["char"]) for u in r["unknown"]], r["samples"]) for r in stats.collect()}
    assert got == {"Dedris-a": ("handled", 2, 5, [(35, "#"), (63, "?")], []), "Dedris-z": ("unhandled", 1, 1, [], []), "Times": ("other", 1, 4, [], ["1. x"])}
    text = {r["kind"]: r["text"] for r in rtf.stats_text(stats).collect()}
    assert text["handled"] == "  Dedris-a: 5 characters\n    # (code 35)\n    ? (code 63)"


def test_tables_from_csv(spark, tmp_path):
    (tmp_path / "keyed.csv").write_text('b,a,c\r\n1,"x, ""y""",3\r\n')
    assert [tuple(r) for r in files.keyed_csv(spark, str(tmp_path / "keyed.csv"), ["a", "b", "none"]).collect()] == [('x, "y"', "1", None)]
    (tmp_path / "blank.csv").write_text("F/1-0.pdf,10,2,1\nF/1-1.pdf,5,0,1\nF/1-2.pdf,x,0,1\n")
    rows = files.pages_by_folder(files.blank_pages(spark, str(tmp_path / "blank.csv"))).orderBy("file_name").collect()
    assert [tuple(r) for r in rows] == [("F", "1-0.pdf", 10, 2, True), ("F", "1-1.pdf", 5, 0, False)]
    (tmp_path / "outline.csv").write_text(",".join(["h"] * 18) + "\n" + ",".join(str(k) for k in range(18)) + "\n")
    row = files.outline(spark, str(tmp_path / "outline.csv")).first()
    assert row["rid"] == "0" and row["vol_end"] == "17" and row["row_idx"] == 0
    made = sinks.csv_files(spark.createDataFrame([("k", 2, 'a"b'), ("k", 1, "x")], "g string, i int, v string"), "g", ["i"], F.array("v", F.lit("z")), ["h", "h"]).first()
    assert tuple(made) == ("k.csv", 'h,h\r\nx,z\r\n"a""b",z\r\n')


def test_pretty_xml_and_headers(spark):
    df = spark.createDataFrame([('<a xmlns="n"><b>x</b><c/></a>',), ("<a>",), (None,)], "v string")
    got = [r[0] for r in df.select(markup.pretty_xml(F.col("v"))).collect()]
    assert got == ['<?xml version="1.0" encoding="UTF-8"?>\n<a xmlns="n">\n  <b>x</b>\n  <c />\n</a>\n', None, None]
    cols = [F.lit(x) for x in ("IE1", "VE1", "UT1", "a&b.txt", "00", "<lb/>x")]
    for layout in markup.LAYOUTS:
        text = spark.range(1).select(markup.tei_document(*cols, layout=layout, id_types={"src_path": "path", "ie_id": "work"}, base="http://x/", encoding="See {}.")).first()[0]
        root = ET.fromstring(text.encode())
        assert [e.text for e in root.iter("{http://www.tei-c.org/ns/1.0}idno")] == ["a&b.txt", "http://x/IE1"] and "<p>See IE1.</p>" in text


