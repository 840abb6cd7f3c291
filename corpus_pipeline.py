"""A training corpus from the documents table: toxic and poor documents go, one document of each
group of near copies stays, and what is left is packed into sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm import minmax, packing, quality, toxicity
from tidepanel.llm.catalog import GOOD_FROM, TOXIC_FROM
from tidepanel.llm.common import table
from tidepanel.session import materialize


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of being toxic is below 0.3.

    NULL and empty texts have no toxic word and stay unless most labelled texts are toxic. Each row is judged by itself, rows
    of one id too. Without labels of both classes nothing is known against any document, and all stay; an empty table stays
    empty. All columns are kept as they are, whatever their names.
    """
    model, chance = toxicity.fit(docs, table(spark, sf_dir, "labels")), _free(docs, "toxic_chance")
    if model.chance is None:
        return docs
    return toxicity.score(docs, model, out=chance).where(F.col(chance) < TOXIC_FROM).select(*docs.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of being of good quality is 0.7 or more.

    NULL and empty texts have the share of good labels as their chance. Each row is judged by itself, rows of one id too. Without
    labels of both classes on texts of this table all documents stay; an empty table stays empty. All columns are kept as they
    are, whatever their names.
    """
    model, chance = quality.fit(docs, table(spark, sf_dir, "labels")), _free(docs, "good_chance")
    if model.chance is None:
        return docs
    return quality.score(docs, model, out=chance).where(F.col(chance) >= GOOD_FROM).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies (five-word shingles, 0.8).

    Documents without an id are in no group and stay. Texts without words (NULL and empty ones too) are copies of nothing and
    stay, each id once. Rows equal in id and text are one document. An id with several texts is several documents: all
    but the one with the least hash go under a number above 2^62, which no other id of such a group loses to. All columns are kept.
    """
    key, digest = _free(docs, "near_key"), _free(docs, "near_digest")
    marked = docs.where("doc_id IS NOT NULL").withColumn(digest, F.xxhash64("text"))
    shared = marked.groupBy("doc_id").agg(F.min(digest).alias("least"), F.max(digest).alias("most")).where("least <> most")
    shared = materialize(shared.select(F.col("doc_id").alias("near_shared"), F.col("least").alias("near_least")), "shared-ids")
    number = F.shiftrightunsigned(F.xxhash64("doc_id", digest), 2) + F.lit(1 << 62)
    own = F.when(F.col("near_least") != F.col(digest), number).otherwise(F.col("doc_id"))
    keyed = marked.join(shared, marked["doc_id"] == shared["near_shared"], "left").select(marked["*"], own.cast("long").alias(key))
    kept = minmax.near_duplicates(keyed, words=5, key=key).where("kept").select(key).distinct()
    once = keyed.join(kept, key, "left_semi").dropDuplicates([key])
    return once.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids. A NULL or empty text is one closing token; rows of one id are packed
    one by one; an empty table gives no pieces."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near_copies", drop_near_copies),
    ("packing", pack),
]

#: trained models and tokenizers have no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each on the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
