"""One query opN_<name> per operator, over its whole table, with production parameters; SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact, fim, line_dedup, minhash, ranked_search, warc
from .common import bounded_sample, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def tokenizer(name: str) -> str:
    """The vocabulary files' place is the tokenizers package's own affair."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .matroska import media_digest

    return media_digest(table(spark, sf_dir, "documents"))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judge

    return judge(table(spark, sf_dir, "documents"))


ORACLES["op3_warc"] = warc.ORACLE


@query
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op10_minhash"] = minhash.ORACLE


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


ORACLES["op7_line_dedup"] = line_dedup.ORACLE


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import scored

    return scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Wanted shares of tokens by language.
TARGETS = {"en": 0.5, "de": 0.2, "fr": 0.15, "es": 0.15}


def labelled_domains(spark: SparkSession, sf_dir: str, most: int = 2_000) -> DataFrame:
    """The labelled table of the mixing operator: the language of at most ``most`` of the documents that ``labels`` covers."""
    docs = table(spark, sf_dir, "documents").selectExpr("doc_id", "text", "lang AS domain")
    covered = bounded_sample(table(spark, sf_dir, "labels").where("doc_id IS NOT NULL").select("doc_id"), most)
    return docs.join(F.broadcast(covered), "doc_id", "left_semi")  # at most ``most`` ids


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents"), labelled_domains(spark, sf_dir), TARGETS)


@query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find

    return find(table(spark, sf_dir, "documents"))


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


ORACLES["op11_fill_in_middle"] = fim.ORACLE


@query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


ORACLES["op12_ranked_search"] = ranked_search.ORACLE


@query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


ORACLES["op13_exact_dedup"] = exact.ORACLE
