"""Sources by format, as rows of PARSED, behind a checksum of their files.

A catalog entry is a dict: id, format, path, and what the format needs (encoding); sha256 if the file is pinned; ranked, False where
rows of workbooks and analyser dictionaries need no numbers: those of several workbooks take a second reading.
Further formats are added by ``register``.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import okuri, text
from ..schema import ALL, ARI, GENERATED, GIVEN, NASI, PARSED, SEARCH_ONLY, SKK_ONLY, SOURCES
from . import files

#: A reader's rows have those columns of PARSED that the format knows; ``note`` is a metric that the row counts for, and a row that isn't ``given`` only counts. Both may be missing.
Reader = Callable[[SparkSession, dict], DataFrame]
READERS: dict[str, Reader] = {}
#: Formats that rank candidates and add none.
COSTS, CLICKS = "mozc", "clickstream"
SEARCH_TAGS, IRREGULAR_TAGS = ("sK", "sk"), ("iK", "ik", "oK", "ok", "rK", "rk")


def register(format: str):
    def put(reader: Reader) -> Reader:
        READERS[format] = reader
        return reader

    return put


#: Metrics that readers note.
NOTES = (
    "skk_okuri_entry", "skk_malformed_entry", "skk_template_entry", "skk_expression_entry", "skk_expression_candidate", "skk_special_candidate", "mozc_flagged_row", "jmdict_search_only_pair", "jmed_without_reading",
    "okuri_generated", "okuri_skipped_lemma", "okuri_skipped_form",
)


def parsed(df: DataFrame, source: str) -> DataFrame:
    """``df`` in PARSED's columns, note and given; those that it lacks get their defaults."""
    default = {"source": F.lit(source), "pos": F.lit(""), "kind": F.lit(NASI), "scope": F.lit(ALL), "confidence": F.lit(GIVEN)}
    own = [(F.col(f.name) if f.name in df.columns else default.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in PARSED]
    note = F.col("note") if "note" in df.columns else F.lit(None).cast("string").alias("note")
    return df.select(*own, note, F.col("given") if "given" in df.columns else F.lit(True).alias("given"))


def check_files(spark: SparkSession, source: dict) -> None:
    """Raise unless the source's file has the pinned sha256."""
    if wanted := source.get("sha256"):
        found = [r[0] for r in spark.read.format("binaryFile").load(source["path"]).select(F.sha2("content", 256)).collect()]  # one file
        if found != [wanted]:
            raise ValueError(f"the checksum of {source['id']} differs")


def noted(spark: SparkSession, source: dict) -> DataFrame:
    """A source's rows as PARSED with note and given: all that it yields and all that it counts, in one reading."""
    if source["format"] not in READERS:
        raise ValueError(f"unknown format: {source['format']}")
    check_files(spark, source)
    return parsed(READERS[source["format"]](spark, source), source["id"])


def read(spark: SparkSession, source: dict) -> tuple[DataFrame, DataFrame]:
    """(rows as PARSED, counters as metric, n) of a source."""
    rows = noted(spark, source)
    return rows.where("given").drop("note", "given"), rows.where("note IS NOT NULL").groupBy(F.col("note").alias("metric")).agg(F.count("*").alias("n"))


def source_table(spark: SparkSession, catalog: list[dict]) -> DataFrame:
    return spark.createDataFrame([(s["id"], s["format"], json.dumps(s, ensure_ascii=False, sort_keys=True), k) for k, s in enumerate(catalog)], SOURCES)


def select(catalog: list[dict], ids: list[str] | None) -> list[str]:
    """The selected ids, all by default; unknown ones raise, sorted."""
    known = [s["id"] for s in catalog]
    if unknown := sorted(set(ids or ()) - set(known)):
        raise ValueError(f"unknown sources: {', '.join(unknown)}")
    return [k for k in known if not ids or k in ids]


def ranked_behind(made: DataFrame, *order: str) -> DataFrame:
    """Generated rows with a rank behind all given ones, in this order; numbers have gaps, no two are equal."""
    return made.orderBy(*order).withColumn("rank", F.lit(1 << 60) + F.monotonically_increasing_id())


def newest_month(listing: DataFrame, file: str, tries: int = 3) -> str:
    """Of a listing (month as YYYY-MM, file), the newest month that has the file, among the newest ``tries`` months."""
    months = listing.select("month").distinct().orderBy(F.desc("month")).limit(tries)
    found = months.join(listing.where(F.col("file") == F.replace(F.lit(file), F.lit("{month}"), F.col("month"))), "month", "left_semi").agg(F.max("month")).first()[0]
    if found is None:
        raise ValueError(f"none of the newest {tries} months has {file}")
    return found


@register("skk")
def _keyed(spark, source):
    rows = files.read_keyed(spark, source["path"], source.get("encoding", "utf-8"))
    return rows.withColumn("note", F.col("counter")).withColumn("given", F.col("counter").isNull())


@register(COSTS)
def _costs(spark, source):
    flagged = F.col("flagged")
    return files.read_word_costs(spark, source["path"]).select("*", F.when(flagged, "mozc_flagged_row").alias("note"), (~flagged).alias("given"))


@register(CLICKS)
def _clicks(spark, source):
    return files.read_clicks(spark, source["path"]).select(F.lit("").alias("reading"), "surface", F.col("clicks").alias("cost"), "rank")


@register("reading-tsv")
def _pairs(spark, source):
    return files.read_pairs(spark, source["path"]).withColumn("pos", F.lit("materialized vocabulary"))


@register("jmed")
def _workbooks(spark, source):
    unread = F.trim("reading") == "-1"
    rows = files.read_workbooks(spark, source["path"], ranked=source.get("ranked", True))
    rank = ["rank"] if "rank" in rows.columns else []
    return rows.select("reading", "surface", F.col("book").alias("pos"), *rank, F.when(unread, "jmed_without_reading").alias("note"), (~unread).alias("given"))


def _all(source: dict, *frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, (parsed(f, source["id"]) for f in frames))


@register("sudachi")
def _analyser(spark, source):
    rows = files.read_analyser(spark, source["path"], keep=True, ranked=source.get("ranked", True))
    for c in ("reading", "surface", "normalized"):
        rows = rows.withColumn(c, text.unescape_code_points(F.col(c)))
    inflected = (F.col("form") != "*") & ~F.col("form").startswith("終止形")
    plain = rows.select("reading", "surface", "pos", F.when(inflected, SEARCH_ONLY).otherwise(ALL).alias("scope"), "cost", *(["rank"] if "rank" in rows.columns else []))
    lemmas = rows.where((F.col("left_id") != -1) & F.col("part").isin("動詞", "形容詞") & (F.col("lemma") != "*") & F.col("conjugation").rlike(okuri.CONJUGATIONS) & ~F.col("conjugation").isin(*okuri.EXCLUDED_CLASSES))
    made, skipped = okuri.from_lemmas(lemmas.select("lemma", "conjugation", "form", "normalized", "surface", "reading", "cost"))
    made = ranked_behind(made.withColumn("note", F.lit("okuri_generated")), "reading", "surface")
    return _all(source, plain, made, skipped.withColumn("given", F.lit(False)))


@register("jmdict")
def _tagged(spark, source):
    rows = files.read_xml(spark, source["path"], okuri.INFLECTIONS, keep=True)
    loan = text.is_katakana(F.col("reading"))
    # A form's priority is what it shares with this reading's, but loanwords and kana entries have both.
    both = F.array_union(F.coalesce("own_pri", F.array().cast("array<string>")), "reading_pri")
    pri = F.array_sort(F.when(F.col("own_pri").isNull() | loan, both).otherwise(F.array_intersect("own_pri", "reading_pri")))
    rows = rows.withColumn("pri", F.when(F.size(pri) > 0, pri)).withColumn("tags", F.when(F.size("inf") > 0, F.col("inf")))
    has = lambda tags: F.coalesce(F.arrays_overlap("inf", F.array(*map(F.lit, tags))), F.lit(False))
    rows = rows.withColumn("search", has(SEARCH_TAGS)).withColumn("odd", has(IRREGULAR_TAGS))
    plain = rows.select("reading", "surface", "pos", F.when(F.col("search"), SEARCH_ONLY).otherwise(ALL).alias("scope"), "pri", F.col("tags").alias("inf"), "rank", F.when(F.col("search"), "jmdict_search_only_pair").alias("note"))
    able = ~F.col("search") & ~F.col("odd") & F.col("has_form") & (F.col("first_form") | (F.size(F.coalesce("own_pri", F.array().cast("array<string>"))) > 0))
    forms = rows.where(able).select("reading", "surface", "pri", F.col("tags").alias("inf"), "rank", F.explode("classes").alias("class"))
    made = ranked_behind(okuri.inflect(forms), "rank", "class", "turn", "okuri_key", "stem").select(
        F.col("okuri_key").alias("reading"), F.col("stem").alias("surface"), F.concat_ws("|", F.lit("okuri-rule"), "class", "reading", F.col("surface")).alias("pos"),
        F.lit(ARI).alias("kind"), F.lit(SKK_ONLY).alias("scope"), "pri", "inf", "rank", F.lit(GENERATED).alias("confidence"), F.lit("okuri_generated").alias("note"),
    )
    return _all(source, plain, made)


def read_all(spark: SparkSession, catalog: list[dict]) -> tuple[DataFrame, DataFrame]:
    """(PARSED rows of all sources, counters as source, metric, n)."""
    both = [read(spark, s) for s in catalog]
    rows = reduce(DataFrame.unionByName, (r for r, _ in both))
    counted = reduce(DataFrame.unionByName, (c.withColumn("source", F.lit(s["id"])) for s, (_, c) in zip(catalog, both)))
    return rows, counted.select("source", "metric", "n")
