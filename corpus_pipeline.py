"""From raw documents to packed training sequences, in five staged steps.

Each stage takes the documents its predecessor kept and is written as Parquet
before the next one reads it. All but the last return the columns of ``documents``
(doc_id, text, lang, source, n_chars); the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickevidence.llm import jaccard, mixing, packing, quality, secrets
from tickevidence.llm.common import held_out, table
from tickevidence.llm.queries import DOMAINS, domain_of_labels, tokenizer
from tickevidence.session import stage_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document below this score goes.
QUALITY = 0.5
#: Near duplicates: five-word shingles, similarity 0.8 and more.
SHINGLE_WORDS, SIMILARITY = 5, 80


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts; a NULL text is scored as empty."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model, COLUMNS).filter(F.col("score") >= QUALITY).drop("score")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each group of near duplicates, and of equal ids the first one.

    Decided by row: rows that share a doc_id, or have none, are compared by their texts like all
    others. NULL ids come last. Rows without words are no duplicates of anything and all stay.
    """
    # The staged key names a row; as the id of the join it also names each component.
    rows = stage_table(docs.select(*COLUMNS).withColumn("row_key", F.monotonically_increasing_id()), "rows")
    linked = jaccard.link_components(rows.select(F.col("row_key").alias("doc_id"), "text"), SHINGLE_WORDS, SIMILARITY)
    linked = linked.select(F.col("doc_id").alias("row_key"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")
    first = linked.join(rows.select("row_key", "doc_id"), "row_key").groupBy("component_id").agg(F.min(order).alias("first"))
    return rows.join(first.select("first.row_key"), "row_key", "left_semi").select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in the text replaced; n_chars follows the text where it changed."""
    found = secrets.scan(docs, COLUMNS)
    changed = F.col("spans") != ""
    text = F.when(changed, F.col("masked")).otherwise(F.col("text"))
    n_chars = F.when(changed, F.length("masked").cast("long")).otherwise(F.col("n_chars"))
    return found.select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at their fitted rates, at most once each; a row's draw is a hash of its doc_id and text.

    Texts without tokens weigh nothing and stay.
    """
    labels = table(spark, sf_dir, "labels").filter(~held_out())
    _, rates, soft = mixing.mix(docs, labels, domain_of_labels(), DOMAINS, highest=1.0, keep=COLUMNS)
    mixed = mixing.with_copies(soft, rates)
    return mixed.filter("copies > 0 OR tokens = 0").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1,024 ids with their ids and their place in a sequence."""
    return packing.pack_documents(docs, tokenizer(), end_id=0, window=1024)


STAGES = [
    ("quality classifier", drop_poor),
    ("n-gram Jaccard join", one_of_each_group),
    ("secret scans", mask_secrets),
    ("mixing to targets", mix_domains),
    ("packing", pack),
]

#: SQL can express neither the compression, the classifier nor the tokenizer; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
