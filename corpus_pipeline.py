"""The corpus pipeline: stages that apply the operators of ``quillspark.llm`` one after another.

Every stage gets all that the stage before it kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm import common, fingerprints, langid, lines, packing, secrets


def _sized(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now; a table without that column stays without."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without an identifiable language (null, empty, without letters); ``lang`` becomes the prediction.

    Rows map one to one, so repeated ones stay; without any labelled text, as in an empty table, nothing is kept.
    """
    common.bounded_batches(spark)
    return langid.keep_identified(docs, langid.fit(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of repeated line runs from the texts; every document stays.

    Null texts stay null; rows that repeat id and text get the same text; a null id comes first.
    """
    return _sized(lines.without_copies(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group: the least id, null first. Null and empty texts are one group."""
    return fingerprints.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; every document stays. Null texts stay null, repeated rows stay."""
    return _sized(secrets.redact(docs, secrets.fit(spark, words=secrets.dictionary(docs))))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes and packs all texts into sequences; one row per piece. A null text is its end id alone."""
    import public_tokenizers as tok

    return packing.pack_documents(docs, tok.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: Automata, token ids and packings have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
