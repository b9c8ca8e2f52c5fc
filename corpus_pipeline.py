"""A corpus pipeline: toxicity, language, near-duplicates, packing.

``STAGES`` lists the stages in order; each takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet to the shared folder of
``spark.checkpoint.dir`` and reads back as the next stage's ``docs``.  All
stages but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import langid, neardup, packing, toxicity
from ledgerline.llm.common import ship_code, table, written
from ledgerline.llm.queries import BPE_JSON


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts as clean.  Null and empty texts are; without
    labels of both kinds nothing is known as toxic, and all stay."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted = 0").select(*docs.columns)


# Languages to keep (None: all that the labels name), and the confidence that a text needs.
WANTED_LANGUAGES: tuple[str, ...] | None = None
LEAST_CONFIDENCE = langid.LEAST_CONFIDENCE


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a wanted language, as the model tells it with enough confidence.

    Null, empty and letterless texts go, and so do texts of languages that were never learned.
    Without any label, all with a letter stay."""
    ship_code(spark)
    return langid.accepted(docs, langid.train(docs), WANTED_LANGUAGES, LEAST_CONFIDENCE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of every group of near-duplicates, once; rows without
    a doc_id stay.

    Rows are told apart by doc_id and text: one of equal rows stays, and each of several texts under one
    doc_id is a document of its own (in this stage such texts go by a negative number
    drawn from both, so that which of them represents a group doesn't depend on the run)."""
    ship_code(spark)
    named = docs.where("doc_id IS NOT NULL").withColumn("__text", F.xxhash64(F.coalesce("text", F.lit(""))))
    several = (named.select(F.col("doc_id").alias("__id"), "__text").distinct().groupBy("__id")
               .agg(F.count("*").alias("__texts")).where("__texts > 1").select("__id", F.lit(True).alias("__several")))
    own = F.when(F.col("__several"), -1 - F.pmod(F.xxhash64("doc_id", "__text"), F.lit((1 << 62)))).otherwise(
        F.col("doc_id").cast("long"))
    rows = named.join(several, F.col("doc_id") == F.col("__id"), "left").withColumn("__key", own)
    groups = neardup.near_duplicates(rows.select(F.col("__key").alias("doc_id"), "text"))
    kept = groups.where("kept").select(F.col("doc_id").alias("__kept"))
    return (rows.join(kept, F.col("__key") == F.col("__kept"), "left_semi").dropDuplicates(["__key"]).select(*docs.columns)
            .unionByName(docs.where("doc_id IS NULL")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest packed into sequences of at most 2048 tokens (see ``pack_documents`` for null texts
    and ids, and repeated rows); nothing left gives no pieces."""
    ship_code(spark)
    return packing.pack_documents(docs, public_tokenizers.path(BPE_JSON))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near duplicates", drop_near_duplicates),
    ("packing", pack),
]

# SQL can't express trained models, MinHash classes of whole texts, or the packing programme.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the whole ``documents`` table; an empty one gives an empty result."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
