"""A corpus pipeline of five stages: quality, language, near-duplicates, decontamination, packing.

Each stage works on what its predecessor kept, which is written as Parquet to the shared folder and read again. A
lost executor costs the tasks it ran, not the stages before. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclemart.llm import decontaminate, langid, packing, quality, simhash
from cyclemart.llm.common import materialise, table
from cyclemart.llm.queries import packing_settings, ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Texts below this likeness to every learned language are rejected, like texts without letters. The floor itself is
#: set by the learned rows, by length: see ``langid.similarity_floors``.
MIN_LIKENESS = 1.0


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects."""
    ship(spark)
    source = docs.withColumnRenamed("score", "_own_score").withColumnRenamed("predicted", "_own_predicted")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    kept = quality.score(source, model).where("predicted = 1").drop("score", "predicted")
    return kept.withColumnRenamed("_own_score", "score").withColumnRenamed("_own_predicted", "predicted").select(*docs.columns)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents without a letter and those unlike every language learned: gibberish, symbol soup, other languages."""
    ship(spark)
    own = {c: f"_own_{c}" for c in ("score", "lang_pred", "likeness")}
    found = langid.identify(docs.withColumnsRenamed(own), langid.fit(docs), likeness=True)
    kept = found.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("likeness") >= MIN_LIKENESS)).drop(*own)
    return kept.withColumnsRenamed({v: k for k, v in own.items()}).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each near-duplicate group: that of the smallest id, nulls last. Rows that share an id, or have none,
    stand for themselves unless their texts are near."""
    ship(spark)
    names = [f"_key_{k}" for k in range(2)]

    def keys(text_hash: Column) -> list[Column]:
        # A null id is a key of its own.
        return [F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit("")).alias(names[0]), text_hash.alias(names[1])]

    kept = simhash.survivors(docs).select(*keys(F.col("text_hash")))
    # Join and removal of repeated rows share one shuffle by the keys.
    found = docs.select("*", *keys(F.xxhash64(F.col("text").cast("string")))).join(kept, names, "left_semi")
    return found.dropDuplicates(names).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents of which the benchmark makes up a twentieth or more."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 1024 ids, one row per piece."""
    ship(spark)
    return packing.pack(docs, packing_settings())


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality), ("language", keep_language), ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated), ("pack", pack),
]

#: SQL cannot express the fitted models; the result is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
