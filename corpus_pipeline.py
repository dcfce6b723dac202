"""From raw documents to packed training sequences: five stages, each one operator of ``skygalley.llm``."""

from __future__ import annotations

from fractions import Fraction

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygalley.llm import dedup, jaccard, language, packing, substring
from skygalley.llm.exchange import materialize, with_row_id

END_ID = 2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language, also one that few rows or none are labelled with: only null texts and texts without
    letters go."""
    model = language.learn(docs)
    columns = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select("doc_id", "text", *columns)
    found = language.identify(rows, model, carry=[f"c{i}" for i in range(len(docs.columns))])
    known = F.col("lang_pred") != language.UNKNOWN
    if not model.languages:
        known = F.col(f"c{docs.columns.index('text')}").rlike(r"\p{L}")
    return found.where(known).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z, the row with the largest doc_id."""
    rows, row = with_row_id(docs)
    # Written with the numbers: file splits, and so the numbers, may differ between jobs.
    rows = materialize(rows, "numbered")
    kept = dedup.exact_copies(rows, carry=[row]).where("kept").select(row)
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts connected by a similarity of 0.8 of their 5-word shingles, the row with the smallest doc_id.

    Rows are known by a 64-bit hash of doc_id and text, not by a place in files that another job may split otherwise. Of
    rows that share id and text, one stays (any, where other columns differ); a row that shares its id with a near copy
    of another text stays for itself. Rows without doc_id come after all others. Texts without words all stay.
    """
    key = "value_key"
    while key in docs.columns:
        key = f"_{key}"
    rows = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    found = jaccard.similar_classes(rows, doc_id=key, width=5, similarity=Fraction(8, 10)).where("n_shingles > 0")
    found = found.groupBy(F.col("doc_id").alias(key)).agg(F.min("component_id").alias("class"), F.count("*").alias("copies"))
    ids = rows.groupBy(key).agg(F.min("doc_id").alias("id"))
    values = materialize(found.join(ids, key), "values")
    first = values.groupBy("class").agg(F.min(F.struct(F.col("id").isNull(), "id", key)).alias("first"))
    judged = values.join(first, "class").withColumn("stays", F.col("first")[key] == F.col(key))
    judged = materialize(judged.where("not stays or copies > 1").select(key, "stays"), "judged")
    repeated = rows.join(judged.where("stays"), key, "left_semi").dropDuplicates([key])
    return rows.join(judged, key, "left_anti").unionByName(repeated).select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 20 words or more that also stand earlier are cut out; the rest is joined by single spaces.

    Texts without such a passage stay as they are; a text of which nothing is left goes.
    """
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(docs.columns)], "doc_id", "text")
    carry = [f"k{i}" for i in range(len(docs.columns))]
    cut = substring.remove_repeats(rows, width=20, carry=carry)
    text = F.col(f"k{docs.columns.index('text')}")
    kept = cut.where("n_removed = 0 or n_removed < n_words")
    return kept.select(
        *[
            (F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(text) if c == "text" else F.col(f"k{i}")).alias(c)
            for i, c in enumerate(docs.columns)
        ]
    )


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids, sequence and offset."""
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(docs, tokenizer, END_ID, size=1024, with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]
# Language models and tokenizers are beyond SQL; ``tests/llm`` compares the run with a plain version of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
