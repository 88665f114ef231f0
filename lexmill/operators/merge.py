"""Merging parsed rows of many sources into one relation that keeps each source's row, and what was counted on the way."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..schema import ALL, ENTRIES, ENTRY_KEY, GENERATED, NASI


def checked(parsed: DataFrame) -> DataFrame:
    """PARSED with key (search key of the reading) and reject: null, unsupported_reading or invalid_surface."""
    keyed = parsed.withColumn("key", text.search_key(F.col("reading")))
    reading_ok = (F.col("reading") != "*") & text.is_supported_reading(F.col("key"))
    reject = F.when(~F.coalesce(reading_ok, F.lit(False)), "unsupported_reading").when(~text.is_valid_surface(F.col("surface")), "invalid_surface")
    return keyed.withColumn("reject", reject)


def first_known(value: Column, rank: Column) -> Column:
    """The value of the lowest rank that has one."""
    return F.min_by(value, F.when(value.isNotNull(), rank))


def widest(scope: Column) -> Column:
    return F.when(F.min(scope) == F.max(scope), F.min(scope)).otherwise(F.lit(ALL))


def common_tags(tags: Column) -> Column:
    """What all rows' tag sets share; null if nothing, or if a row has none. Only different sets are gathered."""
    sets = F.collect_set(F.coalesce(tags, F.array().cast("array<string>")))
    shared = F.aggregate(sets, F.get(sets, F.lit(0)), lambda a, x: F.array_intersect(a, x))
    return F.when(F.size(shared) > 0, F.array_sort(shared))


def least_ranks(rows: DataFrame) -> DataFrame:
    """Rows of ``fold`` that differ in rank and cost only as one, with the least of both; which says all that folding asks of them."""
    return rows.groupBy(*ENTRY_KEY, "scope", "pri", "pos", "original_reading", "confidence", "inf").agg(F.min("rank").alias("rank"), F.min("cost").alias("cost"))


def fold(rows: DataFrame, often: bool = False) -> DataFrame:
    """Rows of (ENTRY_KEY, scope, rank, cost, pri, pos, original_reading, confidence, inf) as ENTRIES, in any order of rows.

    rank and cost: least known. scope: the rows' own if it is one, else all. pri: the first known. inf: shared tags. The rest is the first row's.
    One shuffle, after each task has folded its own rows. often: keys come many times, with few different values, as words of a corpus do: then rows that differ in rank and cost
    only are folded first, by a hash aggregate of numbers, since one that keeps strings has to sort its rows.
    """
    rows = least_ranks(rows) if often else rows
    rank = F.col("rank")
    first = lambda c: F.min_by(c, rank).alias(c)
    merged = rows.groupBy(*ENTRY_KEY).agg(
        widest(F.col("scope")).alias("scope"), F.min("rank").alias("rank"), F.min("cost").alias("cost"), first_known(F.col("pri"), rank).alias("pri"),
        first("pos"), first("original_reading"), first("confidence"), common_tags(F.col("inf")).alias("inf"),
    )
    return merged.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in ENTRIES))


def entries(parsed: DataFrame) -> DataFrame:
    return accepted(checked(parsed))


def accepted(rows: DataFrame) -> DataFrame:
    """ENTRIES of the ``checked`` rows that aren't rejected."""
    return fold(rows.where("reject IS NULL").withColumnRenamed("reading", "original_reading").withColumnRenamed("key", "reading"))


def checked_titles(parsed: DataFrame) -> DataFrame:
    """As ``checked``, for rows that only have a title."""
    return parsed.withColumn("key", F.col("reading")).withColumn("reject", F.when(~text.is_valid_surface(F.col("surface")), "invalid_surface"))


def metrics(notes: tuple[str, ...]) -> list[Column]:
    """What is counted of ``checked`` rows with note and given: rows, rejects by reason, readings that lost a separator, and notes. As aggregates for ``DataFrame.observe``."""
    given = F.col("given")
    joined = F.col("reject").isNull() & (text.normalize(F.col("reading")) != F.col("key"))
    counts = {"parsed_pairs": given, "separator_joined_pairs": given & joined} | {r: given & (F.col("reject") == r) for r in ("unsupported_reading", "invalid_surface")}
    return [F.count_if(F.coalesce(c, F.lit(False))).alias(m) for m, c in (counts | {n: F.col("note") == n for n in notes}).items()]


def least_costs(parsed: DataFrame, keys=("reading", "surface", "source"), cost: str = "cost") -> DataFrame:
    return parsed.groupBy(*keys).agg(F.min(cost).alias(cost))


def total_clicks(parsed: DataFrame, keys=("surface", "source"), cost: str = "cost", out: str = "clicks") -> DataFrame:
    return parsed.groupBy(*keys).agg(F.sum(cost).alias(out))


def reject_counts(parsed: DataFrame) -> DataFrame:
    """source, metric, n: rows parsed, rows rejected by reason, and readings that lost a separator. Rows that are alike are counted first and checked once."""
    rows = checked(parsed.groupBy("source", "reading", "surface").agg(F.count("*").alias("n")))
    metric = F.explode(F.filter(F.array(F.lit("parsed_pairs"), "reject", F.when(F.col("reject").isNull() & (text.normalize(F.col("reading")) != F.col("key")), "separator_joined_pairs")), lambda x: x.isNotNull()))
    return rows.select("source", "n", metric.alias("metric")).groupBy("source", "metric").agg(F.sum("n").alias("n"))


def totals(merged: DataFrame) -> DataFrame:
    """One row over ENTRIES: different nasi readings, nasi pairs, ari pairs, ari pairs that no source gives."""
    pairs = merged.groupBy("reading", "surface", "kind").agg(F.bool_and(F.col("confidence") == GENERATED).alias("made"))
    nasi = F.col("kind") == NASI
    return pairs.agg(F.countDistinct(F.when(nasi, F.col("reading"))).alias("readings"), F.count_if(nasi).alias("nasi_pairs"), F.count_if(~nasi).alias("ari_pairs"), F.count_if(~nasi & F.col("made")).alias("generated_pairs"))


def ranking_totals(costs: DataFrame, clicks: DataFrame) -> DataFrame:
    """One row: different pairs with a word cost, different titles with clicks."""
    pairs = costs.agg(F.countDistinct("reading", "surface").alias("ranking_pairs"))
    return pairs.join(F.broadcast(clicks.agg(F.countDistinct("surface").alias("ranking_titles"))), F.lit(True))  # one row each


def traced(merged: DataFrame, sources: DataFrame, fields: tuple[str, ...] = ("version", "license")) -> DataFrame:
    """``provenance`` with what the sources' metadata say about each row's source; rows of unlisted sources stay, with nulls."""
    about = sources.select(F.col("id").alias("source"), *(F.get_json_object("metadata", f"$.{f}").alias(f) for f in fields))
    return provenance(merged).join(about, "source", "left")


def per_source(merged: DataFrame, ids: list[str]) -> DataFrame:
    """id, n, generated for every id, zero for those without rows."""
    spark = merged.sparkSession
    found = merged.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("confidence") == GENERATED).alias("generated"))
    listed = spark.createDataFrame([(i,) for i in ids], "id string")
    return listed.join(found, listed["id"] == found["source"], "left").select("id", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("generated", F.lit(0)).alias("generated"))


def provenance(merged: DataFrame) -> DataFrame:
    """Each source's row with the rule that made it, if one did; strings in the order of the key."""
    rule = F.when(F.col("confidence") == GENERATED, F.col("pos")).otherwise("")
    return merged.select("reading", "surface", "source", "original_reading", "kind", "scope", "confidence", rule.alias("rule")).orderBy("reading", "surface", "source", "kind")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
