"""A training corpus out of raw documents, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlattice.llm import bpe, exact_dedup, jaccard_join, mixing, toxicity
from revlattice.llm.common import dropped, written
from revlattice.llm.queries import POWERS, RANKS, toxicity_field, with_topic

#: The mixture keeps about this share of the tokens.
KEPT_TOKENS = 0.8
#: Characters of a chunk in the last stage, which runs in workers that earlier stages have filled.
ENCODING_CHARS = 5_000_000
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: The name under which the stages carry a row, so that no column of the caller's can be in the way.
ROW = "_carried_row"


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger does not reject; null and empty texts have nothing to reject and stay."""
    return toxicity.without_toxic(docs, toxicity_field(spark, docs, sf_dir))


def _carried(docs: DataFrame, **more: Column) -> DataFrame:
    """Every row as one column, with what a stage needs of it beside."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(ROW), *(c.alias(n) for n, c in more.items()))


def _one_of_each(keyed: DataFrame, kept: DataFrame, key: list[str]) -> DataFrame:
    """The rows of ``keyed`` whose ``key`` (never null) is in ``kept``; of rows that share it the one with the least hash."""
    first = Window.partitionBy(*key).orderBy(F.xxhash64(ROW), F.hash(ROW))
    met = keyed.join(kept.select(*key), key, "left_semi").withColumn("place", F.row_number().over(first))
    return met.filter("place = 1").select(f"{ROW}.*")


def _id_key() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("long").cast("string")), F.lit("-"))


def _text_key(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays: of the smallest id, without one only where no other row has an id.

    Verdicts hold for id and text, so that rows which repeat an id are told apart; of those with one text any one stays.
    Null and empty texts are equal.
    """
    kept = exact_dedup.exact_duplicates(docs).filter("kept").select(_id_key().alias("id_key"), F.col("text_sha256").alias("text_key")).distinct()
    keyed = _carried(docs, id_key=_id_key(), text_key=F.sha2(exact_dedup.normalised("text"), 256))
    return _one_of_each(keyed, kept, ["id_key", "text_key"])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows that links of the Jaccard join connect one stays: of the smallest id, without one only where no other has an id.

    Rows are known by id and the SHA-256 of their text, so that rows which repeat an id are told apart; rows that are equal in
    both are one. Texts without words are linked with nothing.
    """
    keyed = _carried(docs, id_key=_id_key(), text_key=_text_key(F.coalesce("text", F.lit(""))), doc_id=F.col("doc_id"), text=F.col("text"))
    # The join tells rows apart by a number: one for each different row, given once.
    different = keyed.groupBy("id_key", "text_key").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    numbered = written(different.withColumn("number", F.monotonically_increasing_id()), "different")
    linked = jaccard_join.linked(numbered.select(F.col("number").alias("doc_id"), "text"))
    component = linked.select(F.col("doc_id").alias("number"), F.col("component_id").alias("component"))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key", "id_key")
    least = numbered.select("number", order.alias("row")).join(component, "number").groupBy("component").agg(F.min("row").alias("least"))
    return _one_of_each(keyed.drop("doc_id", "text"), least.select("least.id_key", "least.text_key"), ["id_key", "text_key"])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that tokens meet the target shares of source, language and topic.

    Every row has the verdict of its own cell; rows that repeat an id, or have none, share a draw. Texts without words have no
    weight and go.
    """
    needed = with_topic(docs.select("doc_id", "source", "lang", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(ROW)))
    weighed = needed.withColumn("tokens", mixing.tokens("text"))
    return mixing.mixed(weighed, list(POWERS), POWERS, share=KEPT_TOKENS, carried=[ROW]).filter("selected").select(f"{ROW}.*")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text that they decode to; null and empty texts have no ids and decode to empty."""
    ranks = bpe.read_ranks(public_tokenizers.path(RANKS))
    decoded = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN, chunk_chars=ENCODING_CHARS), ranks)
    return decoded.selectExpr("doc_id", "cast(size(ids) as long) AS n_tokens", "ids", "decode(decoded, 'UTF-8') AS text")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing", mixture),
    ("byte-level BPE", encoding),
]
#: The tagger of the first stage has no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's table is deleted once the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name.replace(" ", "-"))
            if before is not None:
                dropped(before)
            before = docs
    return docs
