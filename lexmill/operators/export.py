"""Ordered outputs: pair lists, ranked candidates, dictionary lines, manifests."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text
from ..runtime import materialized, publish
from ..schema import ALL, ARI, NASI, SEARCH_ONLY
from ..sources import files
from . import integrity

#: A line of a dictionary has at most so many characters of key and candidates.
ENTRY_CHARS = 30_000


def reading_pairs(merged: DataFrame, ids: list[str]) -> DataFrame:
    """reading, surface for searching: different pairs in binary order. No selected pair raises when read through ``non_empty``."""
    rows = merged.where(F.col("source").isin(ids) & (F.col("kind") == NASI) & F.col("scope").isin(ALL, SEARCH_ONLY))
    return rows.select("reading", "surface").distinct().orderBy("reading", "surface")


def non_empty(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("No pairs selected")
    return df


def ranked_pairs(ari: DataFrame, nasi: DataFrame) -> DataFrame:
    """kind, key, surface, position of ``rank.positions`` frames, ari keys descending, then nasi keys ascending."""
    both = ari.select(F.lit(ARI).alias("kind"), F.col("reading").alias("key"), "surface", "position").unionByName(nasi.select(F.lit(NASI).alias("kind"), F.col("reading").alias("key"), "surface", "position"))
    return in_order(both)


def in_order(pairs: DataFrame) -> DataFrame:
    is_ari = F.col("kind") == ARI
    return pairs.orderBy(F.when(is_ari, 0).otherwise(1), F.when(is_ari, F.col("key")).desc(), F.when(~is_ari, F.col("key")).asc(), "position")


def order_errors(rows: DataFrame, line: str = "line_no", kind: str = "kind", key: str = "key") -> DataFrame:
    """Rows (line, kind, key) whose key comes back or comes before its predecessor's in the section's direction.

    Predecessors are looked up by a join on the line number, so no single task sorts all rows.
    """
    nxt = rows.select((F.col(line) + 1).alias("_l"), F.col(kind).alias("_kind"), F.col(key).alias("_key"))
    joined = rows.join(nxt, F.col(line) == F.col("_l"))
    changed = ~(F.col(kind).eqNullSafe(F.col("_kind")) & F.col(key).eqNullSafe(F.col("_key")))
    wrong = ((F.col("_kind") == NASI) & (F.col(kind) == ARI)) | ((F.col(kind) == F.col("_kind")) & ((F.col(key) > F.col("_key")) == (F.col(kind) == ARI)))
    return joined.where(changed & (wrong | ~F.col(kind).isin(ARI, NASI))).select(*rows.columns)


def judged_pairs(pairs: DataFrame, cap: int = ENTRY_CHARS) -> DataFrame:
    """kind, key, surface, position, verdict: kept, or why not (unsupported_key, unsafe_candidate, duplicate, overlong_entry).

    The cap is a greedy fit: a candidate that doesn't fit is passed over, a later shorter one may still fit. Where all of a key's
    candidates fit together, as a running sum shows, nothing has to be tried one after the other.
    """
    again = F.row_number().over(Window.partitionBy("kind", "key", "surface").orderBy("position")) > 1
    # Dealt by the key, rows are together for both windows, and sorted once.
    rows = pairs.select("kind", "key", "surface", "position").repartition("kind", "key").withColumn("verdict", F.coalesce(_wrong(), F.when(again, "duplicate")))
    return _capped(rows, cap)


def judged_candidates(pairs: DataFrame, cap: int = ENTRY_CHARS) -> DataFrame:
    """As ``judged_pairs``, a row for each different candidate of a key: its first position, and n, how often it comes; n - 1 of a valid one are duplicates. Each task folds its own rows before any is moved.

    The folded rows are ``materialized``; where every key's candidates fit, as sums by key show, that is all.
    """
    different = materialized(pairs.groupBy("kind", "key", "surface").agg(F.min("position").alias("position"), F.count("*").alias("n")).withColumn("verdict", _wrong()))
    sizes = different.where("verdict IS NULL").groupBy("kind", "key").agg(F.sum(F.char_length("surface") + 1).alias("size"))
    if sizes.where(F.char_length("key") + F.col("size") > cap).isEmpty():
        return different.withColumn("verdict", F.coalesce("verdict", F.lit("kept")))
    return _capped(different, cap)


def candidate_counts(pairs: DataFrame, cap: int = ENTRY_CHARS) -> DataFrame:
    """What ``verdict_counts`` tells of ``judged_candidates``. Candidates are moved once, folded and without their positions, and only to be counted; those of keys whose candidates don't all fit are judged one by one."""
    different = pairs.groupBy("kind", "key", "surface").agg(F.count("*").alias("n")).withColumn("verdict", _wrong())
    own = F.sum(F.when(F.col("verdict").isNull(), F.lit(1).cast("long")).otherwise(F.col("n")))
    totals = materialized(different.groupBy("kind", "key", "verdict").agg(F.sum("n").alias("n"), own.alias("own"), F.sum(F.char_length("surface") + 1).alias("size")))
    over = totals.where(F.col("verdict").isNull() & (F.char_length("key") + F.col("size") > cap)).select(F.col("kind").alias("of_kind"), F.col("key").alias("of_key"))
    if over.isEmpty():
        return _metrics(totals.withColumn("verdict", F.coalesce("verdict", F.lit("kept"))))
    same = F.col("kind").eqNullSafe(F.col("of_kind")) & (F.col("key") == F.col("of_key"))
    fit = totals.join(over, same, "left_anti").select("kind", "key", F.coalesce("verdict", F.lit("kept")).alias("verdict"), "n", "own")
    return _metrics(fit.unionByName(_by_key(judged_candidates(pairs.join(over, same, "left_semi"), cap))))


def _wrong() -> Column:
    ok_key, ok_value = text.is_valid_dictionary_key(F.col("kind"), F.col("key")), text.is_valid_candidate(F.col("surface"))
    return F.when(~ok_key, "unsupported_key").when(~ok_value, "unsafe_candidate")


def _capped(rows: DataFrame, cap: int) -> DataFrame:
    """``rows`` whose verdict is null where nothing is wrong yet, with kept or overlong_entry there."""
    own = [c for c in rows.columns if c != "verdict"]
    size = F.char_length("key") + F.sum(F.when(F.col("verdict").isNull(), F.char_length("surface") + 1).otherwise(0)).over(Window.partitionBy("kind", "key"))
    sized = rows.withColumn("size", size)
    over = F.col("verdict").isNull() & (F.col("size") > cap)
    told = sized.where(~over).select(*own, F.coalesce("verdict", F.lit("kept")).alias("verdict"))
    tried = greedy_fit(sized.where(over).select(*own), ["kind", "key"], "position", F.char_length("surface") + 1, F.char_length("key"), cap)
    return told.unionByName(tried.select(*own, F.when(F.col("fits"), "kept").otherwise("overlong_entry").alias("verdict")))


def greedy_fit(rows: DataFrame, keys: list[str], order: str, need: Column, start: Column, cap: int) -> DataFrame:
    """``rows`` with fits: whether a row still fits behind those of its key that fitted before it, ``start`` being taken already.

    A key's rows run through one task in order, and all that is held of them is the size so far: linear in time, whatever a key's rows.
    """
    used = "need_", "start_", "fits"
    if clash := set(used) & set(rows.columns):
        raise ValueError(f"columns of these names are in use: {', '.join(sorted(clash))}")
    sized = rows.withColumns({"need_": need.cast("long"), "start_": start.cast("long")}).repartition(*keys).sortWithinPartitions(*keys, order)

    def run(batches):
        key, size = object(), 0
        for b in batches:
            column = lambda c: b.column(b.schema.get_field_index(c)).to_pylist()  # noqa: B023, E731
            fits = []
            for k, n, first in zip(zip(*(column(c) for c in keys)), column("need_"), column("start_")):
                if k != key:
                    key, size = k, first
                fits.append(size + n <= cap)
                size += n if fits[-1] else 0
            kept = [c for c in b.schema.names if c not in used]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in kept), pa.array(fits, pa.bool_())], [*kept, "fits"])

    return sized.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("fits", T.BooleanType())]))


def verdict_counts(judged: DataFrame) -> DataFrame:
    """metric, n: pairs in, pairs and keys out by kind, and pairs by what was wrong, of ``judged_pairs`` or ``judged_candidates``. One pass: pairs are counted by key first."""
    return _metrics(_by_key(judged))


def _by_key(judged: DataFrame) -> DataFrame:
    """kind, key, verdict, n (pairs), own (pairs that aren't duplicates)."""
    valid = F.col("verdict").isin("kept", "overlong_entry")
    many = F.col("n") if "n" in judged.columns else F.lit(1).cast("long")
    return judged.groupBy("kind", "key", "verdict").agg(F.sum(many).alias("n"), F.sum(F.when(valid, F.lit(1).cast("long")).otherwise(many)).alias("own"))


def _metrics(by_key: DataFrame) -> DataFrame:
    kept = F.col("verdict") == "kept"
    some = [
        F.struct(F.lit("input_pairs").alias("metric"), F.col("n").alias("n")), F.struct(F.when(kept, F.concat("kind", F.lit("_pairs"))).otherwise(F.concat("verdict", F.lit("_pairs"))).alias("metric"), F.col("own").alias("n")),
        F.struct(F.when(F.col("n") > F.col("own"), "duplicate_pairs").alias("metric"), (F.col("n") - F.col("own")).alias("n")),
        F.struct(F.when(kept, F.concat("kind", F.lit("_readings"))).alias("metric"), F.lit(1).cast("long").alias("n")),
    ]
    each = by_key.select(F.explode(F.array(*some)).alias("x")).select("x.*").where("metric IS NOT NULL")
    return each.groupBy("metric").agg(F.sum("n").alias("n"))


def dictionary_lines(judged: DataFrame) -> DataFrame:
    """kind, key, line ("key /a/b/") of the kept candidates."""
    kept = judged.where("verdict = 'kept'").groupBy("kind", "key").agg(F.array_sort(F.collect_list(F.struct("position", "surface"))).alias("c"))
    return kept.select("kind", "key", F.concat("key", F.lit(" /"), F.array_join(F.transform("c", lambda x: x["surface"]), "/"), F.lit("/")).alias("line"))


def write_dictionary(judged: DataFrame, path: str, headers: tuple[str, ...] = ()) -> dict[str, int]:
    """The dictionary as text in order, both section headers always there; returns its counts. Without any candidate it raises."""
    spark, lines = judged.sparkSession, dictionary_lines(judged)
    stats = {r["metric"]: r["n"] for r in verdict_counts(judged).collect()}  # a dozen rows
    stats["pairs"] = stats.get("ari_pairs", 0) + stats.get("nasi_pairs", 0)
    stats["readings"] = stats.get("ari_readings", 0) + stats.get("nasi_readings", 0)
    if not stats["pairs"]:
        raise ValueError("the dictionary has no candidates")
    head = [(0, k, h) for k, h in enumerate([";; -*- mode: fundamental; coding: utf-8 -*-", *(f";; {h}" for h in headers), ";; okuri-ari entries."])] + [(2, 0, ";; okuri-nasi entries.")]
    fixed = spark.createDataFrame(head, "part int, n int, line string").select("part", "n", F.lit("").alias("key"), "line")
    body = lines.select(F.when(F.col("kind") == ARI, 1).otherwise(3).alias("part"), F.lit(0).alias("n"), "key", "line")
    ordered = fixed.unionByName(body).orderBy("part", "n", F.when(F.col("part") == 1, F.col("key")).desc(), F.when(F.col("part") == 3, F.col("key")).asc())
    publish(ordered.select("line"), path, lambda w, at: w.text(at))
    return stats


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """kind, key, surface, rank of the candidates of a dictionary that ``write_dictionary`` has written, in its order. Its files are read as one, in parts."""
    rows = files.read_keyed(spark, path, whole=True)
    return rows.where("surface IS NOT NULL").select("kind", F.col("reading").alias("key"), "surface", "rank")


def rebuilt(judged: DataFrame, path: str) -> DataFrame:
    """kind, key, surface, side of the kept candidates that a written dictionary lacks (one), or has and shouldn't (two); none if it is what ``judged`` makes."""
    return unlike(judged, read_dictionary(judged.sparkSession, path))


def unlike(judged: DataFrame, written: DataFrame) -> DataFrame:
    """As ``rebuilt``, of a dictionary that has been read."""
    kept = judged.where("verdict = 'kept'").select("kind", "key", "surface")
    return integrity.changed_rows(kept, written.select("kind", "key", "surface"), "key")


def write_pairs(pairs: DataFrame, path: str) -> None:
    """Columns as tab-separated lines, in the frame's order, over as many files as there are ranges; their names keep the order."""
    publish(non_empty(pairs).select(F.concat_ws("\t", *pairs.columns)), path, lambda w, at: w.text(at))


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """path (behind the folder), sha256, bytes of each file of an output."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return found.select(F.substring_index("path", "/", -1).alias("path"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def manifest(spark: SparkSession, path: str, catalog: list[dict], ids: list[str], **extra) -> str:
    """JSON about an output: its files' digests, the sources that went in, and what else is given."""
    listed = [r.asDict() for r in file_digests(spark, path).orderBy("path").collect()]  # one row per output file
    return json.dumps({"files": listed, "sources": [s for s in catalog if s["id"] in ids], **extra}, ensure_ascii=False, indent=2)
