"""A corpus pipeline over ``documents``: judge quality, drop repeated lines, drop near-duplicates, mix languages, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``. No stage can be said in SQL as a whole (the first learns its rules' accuracies), so there is no ORACLE_SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import common, line_dedup, minhash, mixing, packing, quality
from lexmill.llm.queries import TARGETS, labelled_domains, tokenizer


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep."""
    return quality.keep_good(docs)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line resembles (Jaccard 0.8); n_chars follows the text."""
    out = line_dedup.remove_lines(docs)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five-word shingles, Jaccard 0.8): the one with the least doc_id.

    Where rows share that doc_id, the one with the least hash of its text. Texts that aren't linked are groups of their own,
    also where they share a doc_id. Of rows without words one stays per doc_id. Rows without a doc_id all stay.
    """
    judged = minhash.grouped(docs, minhash.Scheme(width=5, percent=80))
    equal = judged.where("doc_id = component_id").groupBy("root", "doc_id", "row").agg(F.count("*").alias("n"))
    least = equal.groupBy("root", "doc_id").agg(F.min(F.struct("row", "n")).alias("least"))
    kept = common.cut(least.select("doc_id", "least.row", "least.n"))
    # Only rows that may have to go, or may be there twice, are shuffled; others are passed on as they are read.
    gone = judged.where("doc_id IS NOT NULL").select("doc_id", "row").join(kept, ["doc_id", "row"], "left_anti")
    unsure = common.sift(gone.union(kept.where("n > 1").select("doc_id", "row")), "doc_id", "row")
    rows = docs.select("doc_id", minhash.row_key(F.col("text")).alias("row"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("all"))
    known = F.col("doc_id").isNotNull()
    sure = rows.where(~known | ~unsure("doc_id", "row"))
    held = rows.where(known & unsure("doc_id", "row")).join(kept.hint("shuffle_hash"), ["doc_id", "row"]).dropDuplicates(["doc_id", "row"])
    return sure.select("all.*").unionByName(held.select("all.*"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated at fitted rates of at least 1, so that expected tokens by language meet TARGETS and no document goes."""
    return mixing.mixed(docs, labelled_domains(spark, sf_dir), TARGETS, budget=None, least=1.0)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [("quality", good_documents), ("lines", fresh_lines), ("near_duplicates", one_of_each_group), ("mixing", mixed), ("packing", packed)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the documents are a table in the shared folder."""
    docs, path = common.table(spark, sf_dir, "documents"), None
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            new = common.scratch(spark, name)
            out.write.parquet(new)
            docs = spark.read.parquet(new)
        if path:
            common.remove(spark, path)
        path = new
    return out
