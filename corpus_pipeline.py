"""A corpus pipeline of the text operators, each stage written and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all of `docs`. All but the last return the
columns of `documents`. A null id is an id of its own, equal to other nulls.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regflow.llm import bpe, exact_dedup, mixing, ngram_join, toxicity
from regflow.llm.common import ascii_lower, stored, table, whole_text


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go. A null text counts as an empty one;
    rows that repeat a text go or stay together; an empty table gives an empty one."""
    return toxicity.clean_rows(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def _id_keys(name: str) -> list[Column]:
    """Two columns that are never null and agree only for equal ids, null being one of them."""
    column = F.col(name)
    return [F.coalesce(column, F.lit(0)).alias("_id"), column.isNull().alias("_no_id")]


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, one row stays: one with the largest id, or with a null id if all ids
    are null. Of several rows with that id and text it is the one with the smallest hash of all its
    columns, the first if they are the same in all. Rows go by their places, so `docs` must be
    read from a table, as `run` does. Texts are shuffled only if the rows that go are too many to be
    sent to all tasks."""
    kept = exact_dedup.exact_duplicates(docs).filter("kept").select(
        F.col("text_sha256").alias("_digest"), *_id_keys("doc_id")
    )
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    keys = ["_digest", "_id", "_no_id"]
    digest = F.sha2(ascii_lower(whole_text("text")), 256).alias("_digest")
    tie = F.xxhash64(*(f"`{c}`" for c in docs.columns)).alias("_tie")
    rows = stored(numbered.select("_row", digest, *_id_keys("doc_id"), tie), "keys")
    first = (
        rows.join(kept.distinct(), keys, "left_semi").groupBy(*keys).agg(F.min(F.struct("_tie", "_row")).alias("first"))
    )
    gone = stored(rows.select("_row").join(first.select("first._row"), "_row", "left_anti"), "gone")
    return numbered.join(gone, "_row", "left_anti").select(docs.columns)


def dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays. Documents with a
    null id are in no group."""
    near = ngram_join.similar_documents(docs).filter("doc_id <> component_id")
    gone = stored(near.select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it: not at all, once or twice."""
    # Written once, so that a row has the same key in the mix and here, whatever its id.
    keyed = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    taken = mixing.mix(keyed, row_col="_row").filter("copies > 0").select("_row", "copies")
    times = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("time")
    return keyed.join(taken, "_row").select(*docs.columns, times).drop("time")


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row: its tokens' number and digest, and the digest of the decoded text. A null text is an
    empty one, without tokens; repeated rows each give a row; an empty table an empty result."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return bpe.digests(bpe.decode(bpe.encode(docs, vocabulary), vocabulary))


STAGES = [
    ("toxicity", clean),
    ("exact_dedup", distinct),
    ("ngram_join", dissimilar),
    ("mixing", mixed),
    ("bpe", tokenised),
]

# The stages learn labels and fit budgets, which SQL cannot express; tests compare each stage
# with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
