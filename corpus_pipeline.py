"""A training corpus from the table ``documents``, stage by stage.

Each stage takes what the one before it wrote. The driver program writes and rereads the
tables between stages; ``run`` does the same in the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrina.llm import packing, pii, quality_rules, shingle_join, suffix_dedup
from vitrina.llm.tables import row_and_text, table
from vitrina.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_text(rows: DataFrame, text) -> DataFrame:
    """The columns of documents from ``row``, with a new text and its length."""
    kept = [F.col(f"row.{name}").alias(name) for name in COLUMNS if name not in ("text", "n_chars")]
    changed = rows.select(*kept, text.alias("text"))
    return changed.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of quality rules keeps."""
    return quality_rules.accepted(docs).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return shingle_join.one_of_each_group(docs).select(*COLUMNS)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without long repeated strings; a text of which nothing is left goes.

    A cut may split a character; what is left of it goes too, and nothing else.
    """
    left = suffix_dedup.without_repeats(row_and_text(docs, "text"), characters=True)
    text = F.when(F.col("n_removed") > 0, F.decode("kept", "UTF-8")).otherwise(F.col("row.text"))
    cut = left.filter("n_removed = 0 OR length(kept) > 0")
    return _with_text(cut.select("row", text.alias("new")), F.col("new"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    found = pii.find(row_and_text(docs, "text").withColumn("original", F.col("text")))
    spans = F.concat("base", "learnt")
    text = F.when(F.size(spans) > 0, pii.redact(F.col("original"), spans)).otherwise(F.col("row.text"))
    return _with_text(found, text)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in training sequences."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.digest(packing.pack(docs, path))


STAGES = [
    ("quality_rules", quality),
    ("shingle_join", near_duplicates),
    ("suffix_dedup", repeated_strings),
    ("pii", personal_data),
    ("packing", packed),
]

#: SQL has no tokenizer; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
