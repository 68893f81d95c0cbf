"""Column functions for XML text, inline annotations, line-break repair and tag placement."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.normalize import normalized, plain_text

LETTER, SUB, VOWEL = "[\u0f40-\u0f6c]", "[\u0f90-\u0fbc]", "[\u0f71-\u0f84]"
# Fixed values of the script, and below the patterns of the repairs.
TSEG, SHAD, TIBETAN = "\u0f0b", "\u0f0d", "[\u0f00-\u0fff]"
TAGS = "((?:<[^>]*>)*)"
DIGITS = "".join(map(chr, range(0x0F20, 0x0F2A)))


def rewrite(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Regex rules as data, applied in order."""
    for pattern, to in rules:
        text = F.regexp_replace(text, pattern, to)
    return text


def escape_xml(text: Column, quotes: bool = False) -> Column:
    """Three entities, or five with ``quotes``; the ampersand first."""
    pairs = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")] + [('"', "&quot;"), ("'", "&apos;")] * quotes
    for a, b in pairs:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, "<[^>]+>", "")


def is_blank_page(text: Column) -> Column:
    return ~strip_tags(text).rlike(r"(?U)\S")


def arabic_digits(text: Column) -> Column:
    return F.translate(text, DIGITS, "0123456789")


def tibetan_digits(text: Column) -> Column:
    return F.translate(text, "0123456789", DIGITS)


def clean_fallback_characters(text: Column) -> Column:
    """Drops a lone letter or ``?`` that a word processor left before Tibetan text, on a line or before a space."""
    return rewrite(text, [(f"^[a-zA-Z?](?={TIBETAN})", ""), (f"\n[a-zA-Z?](?={TIBETAN})", "\n"), (f"\n[a-zA-Z?] (?={TIBETAN})", "\n"), (r"(?d)\n[a-zA-Z?](?=\n?\z)", "\n"), ("(?md)^[a-zA-Z?]$", ""), ("(?md)^[a-zA-Z?] ", "")])


def _rejoin(text: Column, before: str, after: str) -> Column:
    return F.regexp_replace(text, f"({before}){TAGS}\n+{TAGS}({after})", "$1$2$3$4")


def join_vowels(text: Column) -> Column:
    return _rejoin(text, f"{LETTER}|{SUB}|{VOWEL}", VOWEL)


def join_subscripts(text: Column) -> Column:
    return _rejoin(text, LETTER, SUB)


def join_letters(text: Column) -> Column:
    return _rejoin(text, f"{LETTER}|{SUB}|{VOWEL}", LETTER)


def join_tseg(text: Column) -> Column:
    return _rejoin(text, f"{LETTER}|{SUB}|{VOWEL}", TSEG)


def repair_line_breaks(text: Column) -> Column:
    """Vowels, subscripts and tsegs at a line's start join the line before; letters don't. Null stays null."""
    return join_tseg(join_subscripts(join_vowels(text)))


def space_hi_tags(text: Column) -> Column:
    return rewrite(text, [(f"({SHAD})(<hi[^>]*>)", "$1 $2"), (rf"({SHAD})(</hi>)((?U)\S)", "$1$2 $3")])


def repair_text(text: Column, line_breaks: bool = True, hi_spacing: bool = True) -> Column:
    text = repair_line_breaks(text) if line_breaks else text
    return space_hi_tags(text) if hi_spacing else text


def has_tibetan(text: Column) -> Column:
    return text.rlike(TIBETAN)


def count_tibetan(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TIBETAN))


def is_tibetan_punctuation(char: Column) -> Column:
    return char.rlike("^[\u0f0b\u0f0d-\u0f11]$")


def ascii_signs(text: Column) -> Column:
    """Sorted distinct printable ASCII characters beyond those of markup: a set in Python, where an expression would
    make an array of every character.
    """

    @F.arrow_udf("array<string>")
    def signs(x: pa.Array) -> pa.Array:
        return pa.array([None if v is None else sorted(_PRINTABLE.intersection(v)) for v in x.to_pylist()], pa.list_(pa.string()))

    return signs(text)


def suspicious_contexts(text: Column, near: int = 15) -> Column:
    """Digits, periods and capitals before a vowel sign, with up to ``near`` characters on either side."""

    @F.arrow_udf("array<string>")
    def contexts(x: pa.Array) -> pa.Array:
        return pa.array([None if v is None else contexts_of(v, near) for v in x.to_pylist()], pa.list_(pa.string()))

    return contexts(text)


_PRINTABLE = frozenset(map(chr, range(0x21, 0x7F))) - set('<>/="')
_SUSPICIOUS = re.compile(f"[0-9.A-Z]{VOWEL}")
_LINE_END = re.compile("[\n\r\u0085\u2028\u2029]")


def contexts_of(text: str, near: int) -> list[str]:
    """The matches of ``.{0,near}`` pair ``.{0,near}``, by the places of the pairs: the pattern itself would look at
    every character ``near`` times.
    """
    found, out, at, k = [m.start() for m in _SUSPICIOUS.finditer(text)], [], 0, 0
    while k < len(found):
        first = found[k]
        start = max(at, first - near)
        for m in _LINE_END.finditer(text, start, first):
            start = m.end()
        end_of_line = _LINE_END.search(text, first, first + 2 * near + 3)
        stop = end_of_line.start() if end_of_line else len(text)
        while k + 1 < len(found) and found[k + 1] <= min(start + near, stop - 1):
            k += 1
        at = min(found[k] + 2 + near, stop)
        out.append(text[start:at])
        k += 1
        while k < len(found) and found[k] < at:
            k += 1
    return out


def comparable_lines(text: Column) -> Column:
    """For comparisons: plain line ends, no white space at line ends, no empty lines first and last."""
    plain = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), r"(?U)[\s&&[^\n]]+(?=\n|\z)", "")
    return F.regexp_replace(plain, r"^\n+|\n+\z", "")


def comparable_text(text: Column) -> Column:
    """For comparisons: no cell marks, plain line ends, no empty lines, trimmed."""
    plain = F.regexp_replace(F.regexp_replace(F.translate(text, "\a", ""), r"\r\n?", "\n"), r"\n+", "\n")
    return F.regexp_replace(plain, r"(?U)^\s+|\s+\z", "")


def strip_pb_numbers(text: Column) -> Column:
    return F.regexp_replace(text, r'<pb\s+n="[^"]*"\s*/>', "<pb/>")


def strip_leading_break(text: Column, sentinel: str = "ZZZZ", cases: int = 3) -> Column:
    """Without the first page break if the text starts with it, and a newline on either side of it; with
    ``cases=2`` only where a newline follows.
    """
    out = text
    for start in [f"\n{sentinel}", f"{sentinel}\n", f"\n{sentinel}\n"][3 - cases :]:
        out = F.when(text.startswith(start), F.substring(text, len(start) + 1, 2**30)).otherwise(out)
    return out


def drop_empty_hi(text: Column) -> Column:
    """Without ``<hi>`` elements that hold line breaks and white space only; three newlines become two."""
    return rewrite(text, [(r'(?s)<hi rend="[^"]+">(?:<lb/>|\s)*</hi>', ""), (r"\n{3,}", "\n\n")])


def drop_carriage_returns(text: Column) -> Column:
    return F.translate(text, "\r\n", "")


def trim_trailing_pages(text: Column, n: Column, sentinel: str = "ZZZZ") -> tuple[Column, Column]:
    """Text without its last n pages, and issues: too few pages (text as it was), or removed pages with text."""
    pages = F.split(text, sentinel, -1)
    size = F.size(pages)
    kept = F.array_join(F.slice(pages, F.lit(1), F.greatest(size - n, F.lit(0))), sentinel)
    gone = F.filter(F.slice(pages, F.greatest(size - n, F.lit(0)) + 1, n), lambda p: ~is_blank_page(p))
    few = (n > 0) & (size <= n)
    issues = F.when(n == 0, F.array().cast("array<string>")).when(few, F.array(F.concat(F.lit("TOO_FEW_PAGES:"), size.cast("string")))).otherwise(F.transform(gone, lambda p: F.concat(F.lit("NOT_BLANK:"), F.left(p, F.lit(100)))))
    return F.when((n == 0) | few, text).otherwise(kept), issues


_CHOICE = "<choice><orig>{0}</orig><%s>{1}</%s></choice>"
#: Inline marks and what they become, in order; parts of a mark are escaped first.
ANNOTATIONS = [
    (r"\{(D\d+(?:-\d+)?)\}", '<milestone xml:id="{0}" unit="section"/>'),
    (r"\{([^}D][^},]*),([^}]+)\}", _CHOICE % ("reg", "reg")),
    (r"\{([^\x00-\x7F][^},]*),([^}]+)\}", _CHOICE % ("reg", "reg")),
    (r"\(([^)]+),([^)]+)\)", _CHOICE % ("corr", "corr")),
    (r"\[([^\[\]]*[\u0f00-\u0fff][^\[\]]*)\]", '<unclear reason="illegible">{0}</unclear>'),
]
_ENTITIES = {ord(c): f"&{name};" for c, name in (("&", "amp"), ("<", "lt"), (">", "gt"), ('"', "quot"), ("'", "apos"))}
_SIGNS = re.compile("[&<>\"']")


def annotated(text: str) -> str:
    """One text with its inline marks as TEI, without ``#`` and with single spaces."""
    for pattern, to in ANNOTATIONS:
        if pattern[1] in text:
            text = re.sub(pattern, lambda m, to=to: to.format(*(g.translate(_ENTITIES) if _SIGNS.search(g) else g for g in m.groups())), text)
    text = text.replace("#", "")
    return re.sub(" {2,}", " ", text) if "  " in text else text


def annotations(text: Column) -> Column:
    """Inline marks to TEI: milestones, variants, corrections (split at the last comma), unclear passages.

    What a mark holds is escaped while it is replaced, so texts go through Python: all of them, as asking first whether
    they hold a mark would make each text twice.
    """

    @F.arrow_udf("string")
    def marks(x: pa.Array) -> pa.Array:
        return pa.array([None if v is None else annotated(v) for v in x.to_pylist()], pa.string())

    return marks(text)


def lines_to_lb(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit("\n<lb/>"))


_HI = r'<hi rend="[^"]+">'
#: Tag placement by flavour, in order. ``pages``: numbered pages; ``pdf``: pages without numbers;
#: ``runs`` and ``direct``: bodies made of runs of a word processor, with and without moving tags over line ends.
PLACEMENTS = {
    "pages": [
        (r"(?U)\n<lb/>\s*(?=<pb)", "\n"), (r"(?U)<lb/>\s*\n\s*(?=<pb)", ""), (r"(?U)\n<lb/>\s*$", ""),
        ("<large>", '<hi rend="head">'), ("<small>", '<hi rend="small">'), ("</(?:large|small)>", "</hi>"),
        (rf"(?Us){_HI}(?:<lb/>|\s)*</hi>", ""), (r"\n{3,}", "\n\n"),
        (r"(?U)(?:<lb/>\s*)+</hi>", "</hi>"), (r"(?U)<lb/>\s*<pb", "<pb"), (r"\n</hi>", "</hi>\n"),
        (rf"({_HI})\n<lb/>", "\n<lb/>$1"), ("<lb/> +", "<lb/>"), (r"\n\n+", "\n"), ("  +", " "),
    ],
    "pdf": [
        (r"(?U)\n<lb/>\s*(?=<pb)", "\n"), (r"(?U)<lb/>\s*\n\s*(?=<pb)", ""), (r"(?U)\n<lb/>\s*$", ""),
        ("<large>", '<hi rend="head">'), ("<small>", '<hi rend="small">'), ("</(?:large|small)>", "</hi>"),
        (r"(?U)(?:<lb/>\s*)+</hi>", "</hi>"), (r"(?U)<lb/>\s*<pb", "<pb"), (r"\n</hi>", "</hi>\n"),
        (rf"({_HI})\n<lb/>", "\n<lb/>$1"), ("<lb/> +", "<lb/>"), (r"\n\n+", "\n"), ("  +", " "),
    ],
    "runs": [
        (r"(?U)^\s+|\s+$", ""), (r"\n", "\n<lb/>"), (" *<lb/> *", "\n<lb/>"), (r"(?U)^\s+|\s+$", ""),
        (rf"(?U){_HI}\s*(?:<lb/>\s*)*</hi>", ""), (rf"(?U)({_HI})\s*\n<lb/>", "\n<lb/>$1"), (r"\n<lb/></hi>", "</hi>\n<lb/>"),
        (r"\n\n+", "\n"), (rf"(?U){_HI}\s*</hi>", ""), (r"(?U)^\s+|\s+$", ""),
    ],
    "direct": [(f"{_HI}</hi>", ""), (r"\n\n+", "\n"), (r"\n", "\n<lb/>"), (" *<lb/> *", "\n<lb/>"), (r"(?U)^\s+|\s+$", "")],
}
PLACEMENT = PLACEMENTS["pages"]


def place_tags(text: Column, flavour: str) -> Column:
    return rewrite(text, PLACEMENTS[flavour])


def escape_outside_sizes(text: Column) -> Column:
    """Three entities, but size elements stay elements."""
    text = escape_xml(text)
    for tag in ("<large>", "</large>", "<small>", "</small>"):
        text = F.replace(text, F.lit(f"&lt;{tag[1:-1]}&gt;"), F.lit(tag))
    return text


def unnumbered_pages_tei(text: Column, sentinel: str = "ZZZZ") -> Column:
    """Pages without numbers: a page break first and at each sentinel, line ends without white space before them.

    Signs of XML are escaped, size elements become ``<hi>``.
    """
    start = strip_leading_break(escape_outside_sizes(text), sentinel, cases=2)
    lines = F.transform(F.split(F.concat(F.lit("<pb/>\n"), F.replace(start, F.lit(sentinel), F.lit("<pb/>"))), "\n", -1), lambda x: F.regexp_replace(x, r"(?U)\s+$", ""))
    return place_tags(F.array_join(lines, "\n<lb/>"), "pdf")


def drop_head_sign_lines(text: Column) -> Column:
    """Without the lines that hold a head sign and strokes only (perhaps after a size tag)."""
    alone = "(?U)^(?:<fs:\\d+>)?\\s*\u0f04\u0f05[\u0f0d \u0f0e]+\\s*$"
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda x: ~x.rlike(alone)), "\n")


def markup_to_tei(text: Column, start_page: Column, placeholders: bool = True, mode: str = "intended") -> Column:
    """Pages, line breaks and size tags to TEI. Pages count from ``start_page``; before them come pages 1 to
    ``start_page - 1`` if ``placeholders``. Two page breaks never share a line: ``as_coded`` deletes the text
    between them on that line, ``intended`` keeps it.
    """
    text = strip_leading_break(text)
    pages = F.split(text, "ZZZZ", -1)
    pb = lambda n: F.concat(F.lit('<pb n="'), n.cast("string"), F.lit('"/>'))
    numbered = F.transform(pages, lambda p, i: F.when(i == 0, p).otherwise(F.concat(pb(start_page + i), p)))
    body = F.concat(pb(start_page), F.lit("\n"), F.array_join(numbered, ""))
    if placeholders:
        earlier = F.transform(F.sequence(F.lit(1), start_page - 1), lambda n: F.concat(pb(n), F.lit("\n")))
        body = F.when(start_page > 1, F.concat(F.array_join(earlier, ""), body)).otherwise(body)
    body = rewrite(lines_to_lb(body), PLACEMENT)
    if mode == "as_coded":
        return rewrite(body, [(r'(<pb n="\d+"/>)[^\n]*?(?=<pb n="\d+"/>)', "$1\n")])
    return rewrite(body, [(r'(<pb n="\d+"/>[^\n]*?)(?=<pb n="\d+"/>)', "$1\n")])


def tei_body(pages: Column) -> Column:
    """``array<struct<page_num, lines: array<struct<line_num, content>>>>`` to a body; empty lines go, empty pages stay.

    Normalising goes through Python where needed, so lines are handled by ``quillspark.plans.tei``; here the
    contents are taken as they are.
    """
    return F.array_join(F.transform(pages, lambda p: F.concat(F.lit('<pb n="'), p["page_num"], F.lit('"/>'), F.array_join(F.transform(F.filter(p["lines"], lambda x: F.trim(x["content"]) != ""), lambda x: F.concat(F.lit("\n<lb/>"), F.trim(x["content"]))), ""))), "\n")


#: Openings and closings of a TEI body: text that starts on a line of its own, text with all its spaces, text in
#: one paragraph without lines of its own, and divisions without a paragraph around them.
LAYOUTS = {"lines": ("<p>\n", "\n</p>\n"), "preserve": ('<p xml:space="preserve">\n', "</p>\n"), "inline": ("<p>", "</p>\n"), "divisions": ("", "")}
ID_TYPES = {"ie_id": "ie_id", "ve_id": "ve_id", "ut_id": "ut_id", "src_path": "src_path", "src_sha256": "src_sha256"}


def tei_document(
    ie_id: Column, ve_id: Column, ut_id: Column, path: Column, sha: Column, body: Column, title: Column | None = None, lang: str = "bo", layout: str = "lines",
    id_types: dict[str, str] = ID_TYPES, base: str = "", statement: str = "Text converted from its source file.", encoding: str | None = None,
) -> Column:
    """A TEI file with a header that names the collection, the volume, the unit, its source and digest.

    ``id_types`` gives the ``type`` of each id, in order; ids of records get ``base`` before them; ``encoding``
    is a note on the encoding in which ``{}`` stands for the collection's id.
    """
    name = title if title is not None else ut_id
    values = {"ie_id": ie_id, "ve_id": ve_id, "ut_id": ut_id, "src_path": path, "src_sha256": sha}
    ids = []
    for key, kind in id_types.items():
        value = escape_xml(F.coalesce(values[key], F.lit("")))
        ids += [F.lit(f'<idno type="{kind}">{"" if key.startswith("src") else base}'), value, F.lit("</idno>\n")]
    note = [] if encoding is None else [F.lit("<encodingDesc>\n<p>"), F.replace(F.lit(encoding), F.lit("{}"), escape_xml(F.coalesce(ie_id, F.lit("")))), F.lit("</p>\n</encodingDesc>\n")]
    opening, closing = LAYOUTS[layout]
    return F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<TEI xmlns="http://www.tei-c.org/ns/1.0">\n<teiHeader>\n<fileDesc>\n<titleStmt><title>'), escape_xml(name),
        F.lit(f"</title></titleStmt>\n<publicationStmt><p>{statement}</p></publicationStmt>\n<sourceDesc><bibl>\n"), *ids,
        F.lit("</bibl></sourceDesc>\n</fileDesc>\n"), *note, F.lit(f'</teiHeader>\n<text>\n<body xml:lang="{lang}">\n{opening}'), body, F.lit(f"{closing}</body>\n</text>\n</TEI>\n"),
    )


def pretty_xml(text: Column, indent: str = "  ") -> Column:
    """XML with a line for each element, indented; null for what is not well-formed."""

    @F.arrow_udf("string")
    def pretty(x: pa.Array) -> pa.Array:
        return pa.array([_pretty(v, indent) for v in x.to_pylist()], pa.string())

    return pretty(text)


def _pretty(text: str | None, indent: str) -> str | None:
    if text is None:
        return None
    try:
        root = ET.fromstring(text.encode())
    except ET.ParseError:
        return None
    if root.tag.startswith("{"):
        ET.register_namespace("", root.tag[1:].partition("}")[0])
    ET.indent(root, indent)
    return '<?xml version="1.0" encoding="UTF-8"?>\n' + ET.tostring(root, encoding="unicode") + "\n"


def line_tei(line: str | None, ra_rule: str = "C") -> str:
    """A line normalised, annotated and trimmed, in that order."""
    return annotated(normalized(line, ra_rule=ra_rule)).strip()


def line_markup(content: Column, ra_rule: str = "C") -> Column:
    """``line_tei`` of each line: in one Arrow pass where a line is not ASCII or holds a mark, else built-in."""

    @F.arrow_udf("string")
    def marked(x: pa.Array) -> pa.Array:
        return pa.array([None if v is None else line_tei(v, ra_rule) for v in x.to_pylist()], pa.string())

    text = F.coalesce(content, F.lit(""))
    special = text.rlike(r"[^\x00-\x7F]|[{(\[]")
    plain = rewrite(plain_text(text), [("#", ""), (" {2,}", " "), (r"^[ \n]+|[ \n]+$", "")])
    return F.coalesce(marked(F.when(special, text)), plain)
