"""Document fingerprints: SimHash of weighted terms, and all fingerprints within a Hamming radius.

Everything here is DataFrame functions. A term is a word with the word after it (lower case, letters
and digits), weighted by the word's length up to ``HEAVY``. Each of the 64 bits of a term's hash votes
with that weight; two 32-bit counters share one long, which cannot overflow because the weights of a
text sum to less than 2^31. A bit of the fingerprint is set if more than half of the weight votes for it.

Search. The bits fall into radius + 3 blocks. Every choice of three blocks gives a table whose key is
the fingerprint with those blocks moved to the front; at most ``radius`` blocks can hold a difference,
so two fingerprints within the radius agree on some choice and meet in that table.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.llm import common

HEAVY, RADIUS, LEAD = 16, 3, 3


def _votes(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys..., fp`` for rows ``keys..., text``: one fingerprint per distinct key."""
    words = F.split(F.lower("text"), r"[^\p{L}\p{N}]+")
    w = texts.select(*keys, words.alias("w")).select(*keys, F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, F.size("w")).alias("b")).alias("t"))
    terms = w.select(*keys, F.inline("t").alias("a", "b"))
    weight = F.least(F.greatest(F.length("a"), F.lit(1)), F.lit(HEAVY)).cast("long")
    lanes = (1 << 32) | 1
    votes = terms.select(*keys, weight.alias("weight"), F.xxhash64("a", "b").alias("h"))
    sums = [F.sum(F.shiftrightunsigned("h", c).bitwiseAND(F.lit(lanes)) * F.col("weight")).alias(f"s{c}") for c in range(32)]
    total = votes.groupBy(*keys).agg(F.sum("weight").alias("total"), *sums)
    low = F.lit((1 << 32) - 1)
    fp = F.lit(0).cast("long")
    for c in range(32):
        for bit, ones in ((c, F.col(f"s{c}").bitwiseAND(low)), (c + 32, F.shiftrightunsigned(f"s{c}", 32))):
            fp = fp.bitwiseOR(F.when(ones * 2 > F.col("total"), F.lit(_signed(1 << bit))).otherwise(F.lit(0).cast("long")))
    return total.select(*keys, fp.alias("fp"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def likeness(a: Column, b: Column) -> Column:
    """Estimated cosine of the weighted terms behind two fingerprints, 0 if negative."""
    return F.greatest(F.cos(F.bit_count(a.bitwiseXOR(b)) * (3.141592653589793 / 64)), F.lit(0.0))


def masks(radius: int = RADIUS, lead: int = LEAD) -> list[int]:
    n = radius + lead
    edge = [round(64 * i / n) for i in range(n + 1)]
    block = [((1 << edge[i + 1]) - 1) ^ ((1 << edge[i]) - 1) for i in range(n)]
    return [_signed(sum(block[i] for i in c)) for c in itertools.combinations(range(n), lead)]


def within_radius(queries: DataFrame, fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``q, fp, weight, distance``: each distinct query fingerprint ``q`` with every row ``fp, weight`` in the radius.

    Each match comes out once: in the first table where the two agree. Null fingerprints match nothing.
    """
    every = F.array(*[F.lit(m) for m in masks(radius)])
    table = F.posexplode(every).alias("t", "mask")
    left = queries.select("q", table).select("q", "t", F.col("q").bitwiseAND(F.col("mask")).alias("k"))
    right = fps.select("fp", "weight", table).select("fp", "weight", "t", F.col("fp").bitwiseAND(F.col("mask")).alias("k"))
    x = F.col("q").bitwiseXOR(F.col("fp"))
    met = left.alias("l").join(right.alias("r"), (F.col("l.t") == F.col("r.t")) & (F.col("l.k") == F.col("r.k")) & (F.bit_count(x) <= radius))
    first = F.array_position(F.transform(every, lambda m: x.bitwiseAND(m) == 0), True) - 1
    return met.where(first == F.col("l.t")).select("q", "fp", "weight", F.bit_count(x).alias("distance"))


def numbered(docs: DataFrame) -> DataFrame:
    """Distinct (doc_id, text) as ``uid, doc_id, n_chars, copies, next_uid``: the next by (doc_id, uid), round to the first.

    The order is found by range partitions; only the first row of each partition goes to the driver.
    """
    spark = docs.sparkSession
    base = docs.groupBy("uid").agg(F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"), F.count("*").alias("copies"))
    dealt = common.cut(base.repartitionByRange(common.shuffle_parts(spark), F.col("doc_id").asc_nulls_first(), "uid").withColumn("pid", F.spark_partition_id()), "order")
    w = Window.partitionBy("pid").orderBy(F.col("doc_id").asc_nulls_first(), "uid")
    firsts = [(r["pid"], r["uid"]) for r in dealt.withColumn("k", F.row_number().over(w)).where("k = 1").select("pid", "uid").orderBy("pid").collect()]  # a row per partition
    follow = [(p, firsts[(i + 1) % len(firsts)][1]) for i, (p, _) in enumerate(firsts)]
    after = spark.createDataFrame(follow, "pid int, after long")
    out = dealt.withColumn("lead", F.lead("uid").over(w)).join(F.broadcast(after), "pid")  # at most a row per shuffle partition
    return common.cut(out.select("uid", "doc_id", "n_chars", "copies", F.coalesce("lead", "after").alias("next_uid")), "numbered")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of documents and of their edited texts (last quarter replaced by the next one's head).

    Null text is empty. Rows that repeat an id and text share one result; rows that repeat only the id
    are ordered by a hash of the text. A null doc_id comes first. A single document is its own next.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text"))
    base = base.withColumn("uid", F.xxhash64("doc_id", "text")).withColumn("n_chars", F.length("text").cast("long"))
    order = numbered(base)
    if not order.limit(1).count():
        return order.select("doc_id", "n_chars", *[F.lit("").alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")], F.lit(0.0).alias("near_edited"), F.lit(0.0).alias("near_next"), F.lit(0).cast("long").alias("n_near"))
    texts = base.select("uid", "text")
    if order.agg(F.max("copies")).first()[0] > 1:
        texts = texts.dropDuplicates(["uid"])
    asks = order.select(F.col("next_uid").alias("uid"), F.col("uid").alias("for_uid"), F.expr("n_chars div 4").cast("int").alias("need"))
    heads = texts.join(asks, "uid").select(F.col("for_uid").alias("uid"), F.col("text").substr(F.lit(1), F.col("need")).alias("head"))
    n = F.length("text")
    edited = F.concat(F.col("text").substr(F.lit(1), n - F.expr("cast(length(text) div 4 as int)")), F.col("head"))
    both = texts.join(heads, "uid").select("uid", "text", edited.alias("edited"))
    either = both.select("uid", F.explode(F.array(F.struct(F.lit(None).cast("string").alias("sha"), F.col("text").alias("text")), F.struct(F.sha2("edited", 256).alias("sha"), F.col("edited").alias("text")))).alias("x")).select("uid", "x.sha", "x.text")
    fps = _votes(either, ["uid", "sha"])
    one = common.cut(fps.groupBy("uid").agg(F.max("sha").alias("edited_sha256"), F.max(F.when(F.col("sha").isNull(), F.col("fp"))).alias("fp"), F.max(F.when(F.col("sha").isNotNull(), F.col("fp"))).alias("edited_fp")), "fps")
    rows = order.join(one, "uid").join(one.select(F.col("uid").alias("next_uid"), F.col("fp").alias("next_fp")), "next_uid")
    weights = rows.groupBy("fp").agg(F.sum("copies").alias("weight"))
    asked = order.where("doc_id % 100 = 0").join(one, "uid").select(F.col("fp").alias("q")).distinct()
    near = within_radius(asked, weights).groupBy("q").agg((F.sum("weight") - 1).alias("n_near"))
    rows = rows.join(near, rows["fp"] == near["q"], "left").withColumn("n_near", F.when(F.col("doc_id") % 100 == 0, F.col("n_near")))
    hexed = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    out = rows.select("doc_id", "n_chars", "edited_sha256", hexed("fp").alias("fingerprint"), hexed("edited_fp").alias("edited_fingerprint"), likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"), "n_near", F.explode(F.sequence(F.lit(1), "copies")).alias("_copy"))
    return out.drop("_copy")


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(common.documents(spark, sf_dir))
