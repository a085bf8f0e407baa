"""The training-data pipeline: five stages, each on all that its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import decontaminate, mixing, quality_rules, simhash, token_files
from barloom.llm._spark import fresh_path, read_table

#: Documents with more than this share of words from the benchmark go; fewer hit words are cut out.
MAX_HIT_SHARE = 0.5
#: Words of a worker's encoder cache: fewer than by default, as an executor still holds what the stages before left,
#: and has up to four workers on two cores, which take turns and have a cache each.
CACHE_WORDS = 40_000


def _columns(docs: DataFrame, text) -> list:
    """The columns of ``docs`` from the struct ``row``, with a new text and its length."""
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return [new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, common lines leave the others; null and empty texts are rejected."""
    return quality_rules.apply_rules(docs).where("kept").select(*_columns(docs, F.col("clean_text")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the smallest id (nulls last), then the smallest text hash.

    Repeated rows are copies; equal rows leave one.
    """
    grouped = simhash.similar_documents(docs, shingle_words=5, similarity=0.8)
    last = F.lit((1 << 63) - 1)
    order = F.struct(F.coalesce("doc_id", last).alias("id"), F.col("doc_id").isNull().alias("none"), F.coalesce("text_key", last).alias("key"))
    kept = grouped.groupBy("component").agg(F.min(order).alias("k")).select("k.*").distinct()
    keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")).select(
        "row", F.coalesce("row.doc_id", last).alias("id"), F.col("row.doc_id").isNull().alias("none"),
        F.coalesce(F.xxhash64("row.text"), last).alias("key"),
    )
    stays = keyed.join(kept, ["id", "none", "key"], "left_semi")
    # Rows equal in id and text leave one; there is a row for each kept key but for those.
    one = stays.groupBy("id", "none", "key").agg(F.min("row").alias("row"))
    return one.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of benchmark windows go; a document mostly made of them goes whole."""
    found = decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    clean = decontaminate.without_spans(F.col("row.text"), F.col("spans"))
    kept = found.where(F.col("n_hit") <= MAX_HIT_SHARE * F.col("n_words"))
    return kept.select(*_columns(docs, F.when(F.col("n_hit") == 0, F.col("row.text")).otherwise(clean)))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 1, 2, 3: a row for each repeat, the last one of a source cut at its budget."""
    rows = mixing.mixed_documents(docs)
    return rows.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's place and digest in the token files, read back from them."""
    read = token_files.token_files(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, cache_words=CACHE_WORDS)
    return read.select("doc_id", "start", "n_tokens", F.crc32("token_ids").alias("ids_crc32"))


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_files", token_output),
]

#: SQL has neither the fingerprints nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
