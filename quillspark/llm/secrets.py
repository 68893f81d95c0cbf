"""Secret scans: candidate strings, and a random forest that removes false positives.

Everything on the texts is DataFrame functions, row by row: one pattern finds candidates, and what lies between
the candidates gives places and neighbouring words. Candidates are runs of at least 16 token characters with a
digit, and any 8 or more characters without white space and quotes that a secret word and an assignment sign
come before. Features of a candidate are its length, shares of character classes, transitions between classes,
coverage by a dictionary of word parts and of the corpus's frequent words, path signs and the words around it. A
forest is trained on labelled findings (a bounded table; the default is generated from a fixed seed) whose
features come from the same expressions, and its trees become nested conditions over the features.
"""

from __future__ import annotations

import functools
import random
import string

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import common

TOKEN = r"A-Za-z0-9+/_.\-"
LONG = rf"(?<![{TOKEN}])(?=[A-Za-z+/_.\-]*+[0-9])[{TOKEN}]{{16,}}+={{0,2}}"
#: What is given to a secret word: the place after an assignment sign is looked for first, and the word before it.
GIVEN = r"(?<=[=: \"'`])(?<=[=:] {0,2}[\"'`]?)(?<=(?i:secret|token|passw(?:or)?d|pwd|pass|api[ _-]?key|access[ _-]?key|private[ _-]?key|credential|apikey)(?:_[A-Za-z]{1,8})?[\"'`]?\]? {0,2}[=:] {0,2}[\"'`]?)[^\s\"'`,;<>(){}\[\]]{8,}+"
CANDIDATE = f"{LONG}|{GIVEN}"
#: Characters of context before a candidate, score from which it is a secret, trees, their depth.
CONTEXT, SECRET_FROM, TREES, DEPTH = 40, 0.5, 25, 6
#: Labelled findings that the default forest is trained on, and frequent words of the corpus in the dictionary.
FINDINGS, WORDS = 4000, 1000
REDACTED = "[SECRET]"

#: Word parts of several languages, for dictionary coverage.
PARTS = (
    "tion ing ment able ible ness ight ough ould ther here that this with from have will they what when your about which their there would been were said each "
    "she her his the and for are but not you all any can had was one our out day get has him how man new now old see two way who its let put say too use "
    "version release build test data file path home user local share lib bin src main index page image static assets example mail http https www com org net "
    "python java script config server client request response report summary january february march april june july august september october november december "
    "isch lich keit heit ung schaft ein eine der die das und nicht für auf mit von sich auch "
    "que los las una por con para como más pero sus ado ido ción mente dad "
    "les des une est pas pour dans sur qui avec eux aux oir ait ent ion ette elle"
).split()
SECRET_WORDS = r"(?i)(secret|token|passw(or)?d|passwd|pwd|api[ _-]?key|access[ _-]?key|private[ _-]?key|auth|bearer|credential|client[ _-]?key|apikey)[^A-Za-z0-9]{0,6}$"
PLAIN_WORDS = r"(?i)(commit|revision|sha\d*|md5|digest|checksum|hash|uuid|guid|etag|isbn|issn|id|order|invoice|ref|see|file|path|url|visit|version|at|page|mail|phone|serial|build)[^A-Za-z0-9]{0,6}$"


def dictionary(docs: DataFrame, n: int = WORDS) -> list[str]:
    """The ``n`` words of 4 to 15 letters that occur most often in all texts (ties by the word), for coverage."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{4,15}(?!\p{L})"), F.lit(0))).alias("w"))
    return [r["w"] for r in words.groupBy("w").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").limit(n).collect()]  # n words


def features(candidate: Column, before: Column, after: Column, words: tuple[str, ...] = ()) -> dict[str, Column]:
    """Named numbers of a candidate, the text before it and the text after it."""
    known = sorted({*PARTS, *words}, key=lambda x: (-len(x), x))
    n = F.greatest(F.length(candidate), F.lit(1)).cast("double")
    share = lambda p: F.regexp_count(candidate, F.lit(p)) / n
    near = F.right(before, F.lit(CONTEXT))
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    return {
        "length": F.least(n, F.lit(200.0)),
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "lower": share("[a-z]"),
        "signs": share("[^A-Za-z0-9]"),
        "transitions": F.regexp_count(candidate, F.lit("[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+")) / n,
        "hex": flag(candidate.rlike("^[0-9a-f]+$|^[0-9A-F]+$")),
        "only_digits": flag(candidate.rlike("^[0-9.+/_-]+$")),
        "dictionary": 1 - F.length(F.regexp_replace(F.lower(candidate), "|".join(known), "")) / n,
        "vowels": share("[aeiouAEIOU]"),
        "distinct": F.size(F.array_distinct(F.split(candidate, ""))) / n,
        "paths": F.regexp_count(candidate, F.lit("[/.]")) / n,
        "dashes": F.regexp_count(candidate, F.lit("[-_]")) / n,
        "prefix": flag(candidate.rlike(r"^(AKIA|ASIA|gh[opsru]_|github_pat_|xox[abprs]-|sk[-_]|pk_|rk_|eyJ|AIza|glpat-|npm_|ya29\.|SG\.)")),
        "secret_word": flag(near.rlike(SECRET_WORDS)),
        "plain_word": flag(near.rlike(PLAIN_WORDS)),
        "assigned": flag(near.rlike(r"[=:]\s*[\"'`]?$")),
        "quoted": flag(near.rlike("[\"'`]$") & after.rlike("^[\"'`]")),
        "address": flag(near.rlike(r"(@|://|www\.)$") | after.rlike("^@")),
        "code": flag(candidate.rlike(r"^[$%{<]|^(os|env|process|config|settings|self|this|get|req|request|args|params|data|ctx)[._]|://|^\*+$|\.\.\.") | after.rlike(r"^[(\[{<]")),
        "blank": flag(candidate.rlike(r"(?i)^(x+|\*+|\.+|-+|_+|0+)[\W_0-9]*$|example|placeholder|changeme|change[-_]me|your[-_]|<.*>|redacted|removed|hidden|required|optional|invalid|expired|missing|unknown|undefined|disabled|enabled|default")),
        "one_word": flag(candidate.rlike(r"^[A-Za-z]?[a-z]+[.!?:]?$")),
        "kinds": F.lit(0.0) + sum((flag(candidate.rlike(c)) for c in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]")), F.lit(0.0)),
    }


def names() -> list[str]:
    return ["length", "digits", "upper", "lower", "signs", "transitions", "hex", "only_digits", "dictionary", "vowels", "distinct", "paths", "dashes", "prefix", "secret_word", "plain_word", "assigned", "quoted", "address", "code", "blank", "one_word", "kinds"]


def labelled_findings(n: int = FINDINGS, seed: int = 11) -> list[tuple[str, str, str, int]]:
    """(before, candidate, after, label) of invented findings: secrets, and what looks like them."""
    r = random.Random(seed)
    pick = lambda a, k: "".join(r.choice(a) for _ in range(k))
    hexa, alnum = "0123456789abcdef", string.ascii_letters + string.digits
    words = [w for w in PARTS if len(w) > 2 and w.isascii()]
    word = lambda: "".join(r.choice(words) for _ in range(r.randint(1, 4)))
    prose = lambda: " ".join(word() for _ in range(r.randint(1, 5)))

    def secret():
        key = r.choice(["token", "secret", "password", "api_key", "API-KEY", "access_key", "auth_token", "client_secret", "passwd", "Bearer", "private_key", "aws_secret_access_key"])
        body = r.choice([lambda: pick(hexa, r.choice([32, 40, 64])), lambda: pick(alnum, r.randint(20, 64)), lambda: pick(alnum + "+/", 43) + "=", lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, 16), lambda: "ghp_" + pick(alnum, 36), lambda: "xoxb-" + pick(string.digits, 12) + "-" + pick(alnum, 24), lambda: "sk-" + pick(alnum, 40), lambda: "eyJ" + pick(alnum + "-_", 60), lambda: pick(alnum, r.randint(10, 16)) + str(r.randint(10, 99)) + pick(alnum, 6)])()
        join, quote = r.choice([" = ", "=", ": ", ":", " "]), r.choice(['"', "'", ""])
        return f"{prose()} {key}{join}{quote}", body, f"{quote}{r.choice([' ', chr(10), '. ', ';'])}{prose()}"

    def bare():
        body = r.choice([lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, 16), lambda: "ghp_" + pick(alnum, 36), lambda: "sk-" + pick(alnum, 44), lambda: "glpat-" + pick(alnum, 20), lambda: "eyJ" + pick(alnum + "-_", 60)])()
        return f"{prose()} ", body, f" {prose()}"

    def password():
        """What people choose, behind a word that says so."""
        key = r.choice(["password", "Password", "passwd", "pwd", "pass", "db_password", "secret", "token", "api_key", "credential"])
        stem = lambda: r.choice(words).capitalize() if r.random() < 0.4 else r.choice(words)
        body = r.choice([
            lambda: "".join(r.choice(words) for _ in range(r.randint(3, 6))), lambda: stem() + stem() + str(r.randint(1, 9999)), lambda: stem() + r.choice("!@#$%&*") + stem() + str(r.randint(0, 99)),
            lambda: pick(alnum + "!@#$%^&*-_+", r.randint(8, 15)), lambda: pick(string.ascii_letters, r.randint(10, 30)), lambda: pick(string.ascii_lowercase, 4) + str(r.randint(0, 9)) + pick(string.ascii_lowercase, 4),
        ])()
        join, quote = r.choice([" = ", "=", ": ", ":"]), r.choice(['"', "'", "", ""])
        return f"{prose()} {key}{join}{quote}", body, f"{quote}{r.choice([' ', chr(10), ', '])}{prose()}"

    def said():
        """What stands behind such a word and is none."""
        key = r.choice(["password", "Password", "secret", "token", "api_key", "pass", "credential"])
        name = "_".join(r.choice(words) for _ in range(r.randint(1, 3)))
        body, after = r.choice([
            lambda: (r.choice(["required", "optional", "invalid", "expired.", "missing", "undefined", "unknown", "disabled", "forgotten", "changeme", "redacted"]), " "),
            lambda: (r.choice(["os.environ", "config.get", "settings.", "self.", "env.", "process.env.", "request.", "args."]) + name, r.choice(["(", "[", " "])), lambda: ("$" + r.choice("{(") * 0 + name.upper(), " "), lambda: ("*" * r.randint(8, 12), " "),
            lambda: ("x" * r.randint(8, 16), " "), lambda: ("your-" + name, " "), lambda: ("http://" + name + ".example.com/" + r.choice(words), " "), lambda: (r.choice(words) + r.choice(words) + r.choice(["ing", "tion", "ment", "able"]), " " + prose()), lambda: ("get_" + name, "("),
        ])()
        join, quote = r.choice([" = ", "=", ": ", ": "]), ""
        return f"{prose()} {key}{join}{quote}", body, after

    def harmless():
        kind = r.randrange(11)
        if kind == 0:
            return f"{prose()} {r.choice(['commit', 'sha256', 'md5', 'revision', 'checksum', 'etag'])}{r.choice([' ', ': ', '='])}", pick(hexa, r.choice([32, 40, 64])), f" {prose()}"
        if kind == 1:
            h = pick(hexa, 32)
            return f"{prose()} {r.choice(['id', 'uuid', 'see', ''])} ", f"{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}", f" {prose()}"
        if kind == 2:
            return f"{prose()} {r.choice(['', '/', 'file '])}", "/".join(word() for _ in range(r.randint(2, 5))) + f"{r.randint(0, 99)}.{r.choice(['py', 'txt', 'html', 'png'])}", f" {prose()}"
        if kind == 3:
            return f"{prose()} {r.choice(['https://', 'http://', 'www.'])}", f"{word()}{r.randint(0, 9)}.{word()}.{r.choice(['com', 'org', 'net'])}/{word()}", f" {prose()}"
        if kind == 4:
            return f"{prose()} {word()}@", f"{word()}{r.randint(0, 99)}.example.com", f" {prose()}"
        if kind == 5:
            return f"{prose()} {r.choice(['order ', 'phone ', 'isbn ', '', 'id: '])}", pick(string.digits, r.randint(16, 24)), f" {prose()}"
        if kind == 6:
            return f"{prose()} ", "_".join(word() for _ in range(r.randint(2, 5))) + f"_{r.randint(0, 999)}", f" {prose()}"
        if kind == 7:
            return f"{prose()} ", "-".join(word() for _ in range(r.randint(2, 5))) + f"-{r.randint(0, 999)}", f" {prose()}"
        if kind == 8:
            return f"{prose()} {r.choice(['password', 'token', 'api_key'])} = \"", r.choice(["x" * r.randint(15, 30) + "1", "your-token-here-0", "example-password-1", "0" * r.randint(16, 32), "1234567890123456", "changeme-changeme-1"]), f"\" {prose()}"
        if kind == 9:
            return f"{prose()} ", f"{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}T{r.randint(10, 23)}.{r.randint(10, 59)}.{r.randint(10, 59)}", f" {prose()}"
        return f"{prose()} ", word() + word() + word() + str(r.randint(0, 9)) + word() + word(), f" {prose()}"

    out = []
    while len(out) < n:
        label = r.random() < 0.5
        pick_one = r.random()
        if label:
            before, body, after = secret() if pick_one < 0.5 else bare() if pick_one < 0.65 else password()
        else:
            before, body, after = harmless() if pick_one < 0.65 else said()
        if len(body) >= 8:
            out.append((before, body, after, int(label)))
    return out


def grow(x: np.ndarray, y: np.ndarray, rng, depth: int = DEPTH, least: int = 4):
    """A tree: a share of secrets, or (feature, threshold, tree below or at it, tree above it)."""
    p = float(y.mean())
    if not depth or len(y) < 2 * least or p in (0.0, 1.0):
        return round(p, 6)
    best = None
    for f in rng.choice(x.shape[1], max(1, int(x.shape[1] ** 0.5) + 1), replace=False):
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        k = np.arange(1, len(v))
        ok = (v[1:] != v[:-1]) & (k >= least) & (len(v) - k >= least)
        if not ok.any():
            continue
        left, right = ones[:-1] / k, (ones[-1] - ones[:-1]) / (len(v) - k)
        gini = np.where(ok, k * left * (1 - left) + (len(v) - k) * right * (1 - right), np.inf)
        i = int(gini.argmin())
        if best is None or gini[i] < best[0]:
            best = (gini[i], int(f), float((v[i] + v[i + 1]) / 2))
    if best is None:
        return round(p, 6)
    _, f, t = best
    low = x[:, f] <= t
    return f, t, grow(x[low], y[low], rng, depth - 1, least), grow(x[~low], y[~low], rng, depth - 1, least)


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 5) -> list:
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(trees):
        i = rng.integers(0, len(y), len(y))
        out.append(grow(x[i], y[i], rng, depth))
    return out


class Forest(list):
    """Trees, and the words of the corpus that their dictionary feature knows."""

    words: tuple[str, ...] = ()


def fit(spark: SparkSession, findings: DataFrame | None = None, limit: int = 20_000, words: list[str] = ()) -> Forest:
    """A forest from ``before, candidate, after, label`` (at most ``limit`` rows, by hash); null rows don't teach.

    ``words`` are frequent words of the corpus (see ``dictionary``).
    """
    key = None if findings is not None else (spark.sparkContext.applicationId, tuple(words))
    if key in _fitted:
        return _fitted[key]
    table = findings if findings is not None else spark.createDataFrame(labelled_findings(), "before string, candidate string, after string, label int")
    table = table.where("candidate is not null and label is not null")
    table = table.select(F.coalesce("before", F.lit("")).alias("before"), "candidate", F.coalesce("after", F.lit("")).alias("after"), "label").orderBy(F.xxhash64("candidate", "before", "after")).limit(limit)
    made = features(F.col("candidate"), F.col("before"), F.col("after"), tuple(words))
    rows = table.select(*[made[n].alias(n) for n in names()], "label").collect()  # bounded by limit
    x = np.array([[float(r[n]) for n in names()] for r in rows]).reshape(-1, len(names()))
    y = np.array([r["label"] for r in rows], float)
    forest = Forest(train(x, y) if len(rows) else [0.0])
    forest.words = tuple(words)
    if key:
        _fitted[key] = forest
    return forest


_fitted: dict = {}


def score(forest: list, of) -> Column:
    """Mean of the trees as nested conditions; ``of(name)`` gives a feature's column."""

    def tree(t) -> Column:
        if not isinstance(t, tuple):
            return F.lit(t)
        f, at, low, high = t
        return F.when(of(names()[f]) <= at, tree(low)).otherwise(tree(high))

    return functools.reduce(lambda a, b: a + b, map(tree, forest)) / float(len(forest))


def with_findings(docs: DataFrame, forest: Forest) -> DataFrame:
    """``row struct<all columns>, text, parts, found, scores``: texts between candidates, candidates and their scores."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    found = F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    rows = rows.withColumn("found", F.coalesce(found, F.array().cast("array<string>")))
    rows = rows.withColumn("parts", F.when(F.size("found") > 0, F.split("text", CANDIDATE, -1)))
    fed = F.transform("found", lambda c, i: F.struct(*[v.alias(k) for k, v in features(c, F.get("parts", i), F.get("parts", i + 1), getattr(forest, "words", ())).items()]))
    rows = rows.withColumn("fed", F.when(F.size("found") > 0, fed))
    scores = F.transform("fed", lambda f: score(forest, lambda name: f[name]))
    return rows.withColumn("scores", scores).drop("fed")


def scan(docs: DataFrame, forest: Forest) -> DataFrame:
    """``doc_id, finding, start, length, score, secret_sha256``: a row per secret, places in code points from 0.

    A score of exactly ``SECRET_FROM`` is a secret. Null and empty texts have none. Repeated rows give repeated
    findings; a null doc_id stays null.
    """
    rows = with_findings(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), forest).where(F.size("found") > 0)
    rows = rows.select("row.doc_id", "parts", F.posexplode(F.arrays_zip(F.col("found").alias("c"), F.col("scores").alias("s"))).alias("finding", "x"), "found")
    before = F.aggregate(F.slice("parts", F.lit(1), F.col("finding") + 1), F.lit(0).cast("long"), lambda a, p: a + F.length(p))
    earlier = F.aggregate(F.slice("found", F.lit(1), F.col("finding")), F.lit(0).cast("long"), lambda a, c: a + F.length(c))
    out = rows.where(F.col("x.s") >= SECRET_FROM)
    return out.select("doc_id", "finding", (before + earlier).alias("start"), F.length("x.c").alias("length"), F.col("x.s").alias("score"), F.sha2("x.c", 256).alias("secret_sha256"))


def redact(docs: DataFrame, forest: Forest) -> DataFrame:
    """All columns of ``docs``, with every secret in ``text`` replaced; null text stays null, repeated rows stay."""
    rows = with_findings(docs, forest)
    cleaned = F.concat(
        F.get("parts", F.lit(0)),
        F.array_join(F.transform("found", lambda c, i: F.concat(F.when(F.get("scores", i) >= SECRET_FROM, F.lit(REDACTED)).otherwise(c), F.get("parts", i + 1))), ""),
    )
    text = F.when(F.exists("scores", lambda s: s >= SECRET_FROM), cleaned).otherwise(F.col("text"))
    return rows.select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    return scan(docs, fit(spark, words=dictionary(docs)))
