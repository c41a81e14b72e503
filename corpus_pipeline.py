"""Cleans, deduplicates, decontaminates, mixes and packs a corpus; each stage is written and reread before the next.

A stage takes (spark, docs, sf_dir). All but the last return rows of ``docs`` with its columns, whatever their names.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from twincheck.llm.decontaminate import decontaminate
from twincheck.llm.mixing import plan_mix, source_targets, training_order, with_size
from twincheck.llm.neardup import near_duplicate_classes
from twincheck.llm.packing import pack_documents
from twincheck.llm.quality import keep_quality, train_quality
from twincheck.llm.scratch import Scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the limits and the trees keep; the trees are trained on the labelled ones among ``docs``.

    Null and empty texts have too few words; repeated rows are judged alike.
    """
    return keep_quality(docs, train_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id; equal rows count as copies too.

    A row goes only if its own text was found to be a copy, so rows of equal id and different texts are judged apart. Of
    rows with equal id and text, the first in the order of the other columns stays. Rows without words or id are no copies.
    """
    found = near_duplicate_classes(docs, with_digest=True).filter("NOT kept")
    dropped = found.selectExpr("doc_id AS dropped_id", "digest AS dropped_digest").distinct()
    others = ", ".join(f"`{c.replace('`', '``')}`" for c in docs.columns if c not in ("doc_id", "text"))
    whole = docs.select(
        F.struct("*").alias("whole"),
        F.expr("coalesce(xxhash64(text), 0L)").alias("digest"),
        F.expr(f"to_json(struct({others}))" if others else "''").alias("others"),
    )
    left = whole.join(dropped, F.expr("whole.doc_id = dropped_id AND digest = dropped_digest"), "left_anti")
    ranked = left.withColumn("rank", F.expr("row_number() OVER (PARTITION BY whole.doc_id, digest ORDER BY others)"))
    return ranked.filter("rank = 1").select("whole.*")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark, repeated rows included; rows of equal id are judged apart."""
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).filter("contaminated")
    leaks = found.selectExpr("doc_id AS leak_id", "digest AS leak_digest").distinct()
    whole = docs.select(F.struct("*").alias("whole"))
    return whole.join(
        leaks, F.expr("whole.doc_id <=> leak_id AND coalesce(xxhash64(whole.text), 0L) = leak_digest"), "left_anti"
    ).select("whole.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mix takes them, up to twice, in the order of their training positions.

    The files written from this hold the order: by name, and row by row within. Documents of no words go with no words.
    """
    sized = with_size(docs.select("doc_id", "source", "text", F.struct("*").alias("whole"))).drop("text")
    short = Scratch(spark, "mix").save(sized.select("source", "size"), "sizes")
    plan = plan_mix(sized, source_targets(short), whole=True)
    return training_order(plan, ["doc_id", "whole"]).select("whole.*")


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of packed token ids. ``sequence`` and ``row`` sort them as the documents' files are sorted, part by part, so
    the order of training goes on from the mix; a scan alone deals the parts to its tasks by their size.

    Rows that come from no file have no such order, and no ``sequence``.
    """
    part = "concat(_metadata.file_path, '@', lpad(_metadata.file_block_start, 20, '0'))"
    try:
        docs.selectExpr(part)
    except AnalysisException:
        return pack_documents(docs)
    return pack_documents(docs, within=part)


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mix_sources),
    ("packing", pack_tokens),
]

#: No SQL trains trees or tokenizes; the tests hold every stage against a plain rebuild.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = scratch.save(docs, f"stage-{number}")
    return docs
