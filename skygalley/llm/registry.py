"""Named queries over the test tables for the operators of this package, and SQL where it can state the result."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skygalley.llm import (
    bpe,
    dedup,
    jaccard,
    language,
    licenses,
    neighbours,
    packing,
    periods,
    sharding,
    substring,
    tokenfiles,
    trie,
    warc,
)
from skygalley.llm.oracle import SQL
from skygalley.session import new_table_root

END_ID = 2
NEAREST = 10


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    found = language.identify(docs, language.learn(docs))
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_classes(_documents(spark, sf_dir), width=3, similarity=Fraction(90, 100))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    index = neighbours.build_index(vectors, NEAREST)
    return neighbours.nearest(index, vectors.where("vec_id % 100 = 0"), NEAREST)


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(_documents(spark, sf_dir), shards=40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = _documents(spark, sf_dir)
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN, decoded=True)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{new_table_root(spark)}/token_ids"
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    tokenfiles.write_ids(_documents(spark, sf_dir), path, tokenizer, END_ID)
    rows = tokenfiles.read_ids(spark, path, with_ids=False)
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup.exact_copies(_documents(spark, sf_dir))
    text_sha256 = F.lower(F.hex("digest")).alias("text_sha256")
    return found.select("doc_id", "keep_id", "group_size", "kept", text_sha256)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(_documents(spark, sf_dir), tokenizer, END_ID, size=1024)


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(_documents(spark, sf_dir), width=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{new_table_root(spark)}/archives"
    warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    captures = warc.resolve_revisits(warc.assemble(warc.read_records(spark, path, payloads=False)))
    copies = captures.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return copies.select(
        F.get("metadata", F.lit(0))["fields"]["page-id"].cast("long").alias("page_id"),
        F.coalesce("origin.response.payload_bytes", "response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.get("origin.metadata", F.lit(0))["fields"]["page-id"].cast("long").alias("refers_to"),
    )


def planted_periods(docs: DataFrame) -> DataFrame:
    """Every tenth document, by the checksum of its id, repeats a part of itself from some word on."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", "text", checksum.alias("h"))

    def repeated(w: Column) -> Column:
        n, g = F.size(w), F.floor(F.col("h") / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        words = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(words, " "))

    # one step of a transform: the words are split once
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    planted = F.transform(F.array(words), repeated)[0]
    return rows.select("doc_id", F.when(F.col("h") % 10 == 0, planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.collapse_runs(planted_periods(_documents(spark, sf_dir)))
    longest_first = lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))
    best = F.array_max(F.transform("runs", longest_first))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "kept_text")
    start, length, period = -F.col("best.s"), F.col("best.n"), -F.col("best.p")
    return rows.select(
        "doc_id",
        "n_runs",
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join("lines", "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("kept_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


def rebuilt_conversations(convs: DataFrame) -> DataFrame:
    """Conversations that share beginnings: up to three first turns are those of every twentieth conversation."""
    heads = convs.where("conv_id % 20 = 0")
    heads = heads.select(F.col("conv_id").alias("of"), F.slice(trie.TURNS, 1, 3).alias("head"))
    met = convs.join(heads, F.col("conv_id") - F.col("conv_id") % 20 == F.col("of"), "left")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    head = F.coalesce(F.slice("head", F.lit(1), h), F.slice(trie.TURNS, 1, 0))
    own = F.slice(trie.TURNS, h + 1, F.size(trie.TURNS))
    return met.select("conv_id", F.concat(head, own).alias(trie.TURNS))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = trie.conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return trie.prefix_trie(rebuilt_conversations(convs)).drop("last_turn")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_language_id,
        op2_ngram_jaccard,
        op3_nearest_neighbours,
        op4_shards,
        op5_byte_bpe,
        op6_token_files,
        op7_exact_dedup,
        op8_packing,
        op9_substring_dedup,
        op10_license_scan,
        op11_warc,
        op12_periodic_runs,
        op13_conversation_trie,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
