"""Corpus pipeline: toxic documents go, one of each group of near-duplicates stays, contaminated documents go, secrets
are masked, and what remains becomes token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of ``docs``, whatever they are called. Null and repeated rows are
handled as each operator says. In the second stage rows that are equal in id and text count once, rows that share an id
alone are documents of their own, and rows without an id always stay. Empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from premia.llm import bpe, decontaminate, neardup, secrets, toxicity
from premia.llm.common import small_batches, stored, table

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
TOXIC_FROM = 0.5
#: Similarity of two sets of five-word shingles from which documents are near copies.
NEAR_PER_CENT = 80
MASK = "[removed]"
_REST = "__rest"


def _packed(docs: DataFrame) -> DataFrame:
    """Id, text, and all other columns in one, so that their names cannot meet those of an operator."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*rest, F.lit(None).cast("int").alias("__end")).alias(_REST))


def _unpacked(rows: DataFrame, like: DataFrame) -> DataFrame:
    return rows.select(*[F.col(c) if c in ("doc_id", "text") else F.col(_REST)[c].alias(c) for c in like.columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below one half."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(_packed(docs), model, keep=("text", _REST))
    return _unpacked(scored.filter(F.col("toxicity") < TOXIC_FROM), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates; a document is an id and a text."""
    kind = docs.schema["doc_id"].dataType
    digest = F.substring(F.sha2(F.coalesce("text", F.lit("")), 256), 1, 32)
    key = F.concat(F.col("doc_id").cast("string"), F.lit(":"), digest)
    named = _packed(docs.filter(F.col("doc_id").isNotNull())).withColumn("__key", key)
    found = neardup.near_duplicates(named, "__key", per_cent=NEAR_PER_CENT)
    number = F.col("doc_id").substr(F.lit(1), F.length("doc_id") - 33).cast(kind)
    first = F.min(F.struct(number.alias("id"), F.col("doc_id").alias("__key"))).alias("first")
    stays = stored(found.groupBy("component_id").agg(first).select("first.__key"), "pipeline-stays")
    # Equal rows meet before they are shuffled, and the join finds them where they are.
    once = named.groupBy("__key").agg(F.first(F.struct("doc_id", "text", _REST)).alias("row"))
    kept = once.join(stays, "__key", "left_semi").select("row.*")
    return _unpacked(kept, docs).unionByName(docs.filter(F.col("doc_id").isNull()))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    found = decontaminate.contamination(_packed(docs), table(spark, sf_dir, "benchmark"), keep=("text", _REST))
    return _unpacked(found.filter(~decontaminate.is_contaminated()), docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced by a mark and ``n_chars`` following the text."""
    owner = F.col(f"{_REST}.source") if "source" in docs.columns else F.lit(None).cast("string")
    found = secrets.scan(_packed(docs).withColumn("__by", owner), owner_col="__by", keep=("text", _REST))
    clean = found.withColumn("text", secrets.masked(F.col("text"), F.col("spans"), MASK))
    if "n_chars" not in docs.columns:
        return _unpacked(clean, docs)
    kind = docs.schema["n_chars"].dataType
    length = F.when(F.size("spans") > 0, F.length("text").cast(kind)).otherwise(F.col(f"{_REST}.n_chars"))
    return _unpacked(clean.withColumn(_REST, F.col(_REST).withField("n_chars", length)), docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digest of the bytes they decode to."""
    tokens = bpe.encode(docs, RANKS, PATTERN, decoded=True)
    return tokens.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("tokens", encode_tokens),
]

#: The models of the first stage and the ids of the last are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with small_batches(spark):
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
