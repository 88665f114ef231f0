"""A search index over readings: exact lookup, and Latin queries as regular expressions."""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import materialized, publish, ship

_VOWELS = "aiueo"
#: Rows of the syllabary by their consonant; syllables that go another way are listed below.
_ROWS = {
    "": "あいうえお", "k": "かきくけこ", "g": "がぎぐげご", "s": "さしすせそ", "z": "ざじずぜぞ", "t": "たちつてと", "d": "だぢづでど", "n": "なにぬねの", "h": "はひふへほ",
    "b": "ばびぶべぼ", "p": "ぱぴぷぺぽ", "m": "まみむめも", "r": "らりるれろ", "x": "ぁぃぅぇぉ", "l": "ぁぃぅぇぉ",
}
_SMALL = {"a": "ゃ", "u": "ゅ", "o": "ょ", "e": "ぇ", "i": "ぃ"}


@lru_cache(maxsize=1)
def syllables() -> dict[str, str]:
    """Latin spelling to kana, by rule."""
    out = {c + v: kana for c, row in _ROWS.items() for v, kana in zip(_VOWELS, row)}
    for c in "kgsztdnhbpmr":
        out |= {f"{c}y{v}": out[f"{c}i"] + small for v, small in _SMALL.items()}
    out |= {f"{c}{v}": base + _SMALL[v] for c, base in (("sh", "し"), ("ch", "ち"), ("j", "じ")) for v in "aueo"}
    out |= {f"f{v}": "ふ" + small for v, small in zip("aieo", "ぁぃぇぉ")} | {f"v{v}": "ゔ" + small for v, small in zip("aieo", "ぁぃぇぉ")}
    out |= {"ya": "や", "yu": "ゆ", "yo": "よ", "wa": "わ", "wo": "を", "wi": "うぃ", "we": "うぇ", "shi": "し", "chi": "ち", "tsu": "つ", "fu": "ふ", "ji": "じ", "vu": "ゔ", "nn": "ん", "n'": "ん", "xn": "ん", "-": "ー"}
    return out | {"xya": "ゃ", "xyu": "ゅ", "xyo": "ょ", "xtu": "っ", "xtsu": "っ", "ltu": "っ"}


def kana_prefixes(latin: str) -> list[str]:
    """Kana that readings may begin with, for a query in Latin letters; an unfinished syllable stands for all that it may become."""
    table, longest = syllables(), max(map(len, syllables()))
    done: set[str] = set()
    open_: list[tuple[str, str]] = [("", latin.lower())]
    while open_:
        kana, rest = open_.pop()
        if not rest:
            done.add(kana)
            continue
        if len(rest) > 1 and rest[0] == rest[1] and rest[0] not in "aiueon-'":
            open_.append((kana + "っ", rest[1:]))
            continue
        hit = next((n for n in range(min(longest, len(rest)), 0, -1) if rest[:n] in table), 0)
        if hit:
            open_.append((kana + table[rest[:hit]], rest[hit:]))
        elif rest[0] == "n" and len(rest) > 1 and rest[1] not in "aiueoy":
            open_.append((kana + "ん", rest[1:]))
        else:
            begun = {k for s, k in table.items() if s.startswith(rest)}
            done |= {kana + k for k in begun} | ({kana + "ん"} if rest == "n" else set())
            if not begun and not rest[0].isascii():
                open_.append((kana + rest[0], rest[1:]))
            elif not begun and rest != "n":
                return []
    return sorted(done)


def build(pairs: DataFrame, path: str, buckets: int = 16) -> None:
    """Write reading, surfaces (sorted, different), sorted by reading within ranges, so that a lookup reads few row groups. Readings with pairs only.

    The written index is compared with the pairs before it takes its place.
    """
    rows = grouped(pairs)

    def writer(w, at):
        w.parquet(at)
        if differences(pairs, rows.sparkSession.read.parquet(at)).take(1):
            raise ValueError("the index differs from its pairs")

    publish(rows.repartitionByRange(buckets, "reading").sortWithinPartitions("reading"), path, writer)


def grouped(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("reading").agg(F.array_sort(F.collect_set("surface")).alias("surfaces"))


def differences(pairs: DataFrame, index: DataFrame) -> DataFrame:
    """Pairs that only one of both has."""
    listed, own = index.select("reading", F.explode("surfaces").alias("surface")), pairs.select("reading", "surface").distinct()
    return own.exceptAll(listed).union(listed.exceptAll(own))


def lookup(spark: SparkSession, path: str, reading: str) -> list[str]:
    row = spark.read.parquet(path).where(F.col("reading") == reading).first()
    return row["surfaces"] if row else []


def matches(index: DataFrame, latin: str) -> DataFrame:
    """Different surfaces whose reading begins as the query may be read."""
    begins = [F.col("reading").startswith(p) for p in [*kana_prefixes(latin), latin.lower()]]
    hit = begins[0]
    for b in begins[1:]:
        hit = hit | b
    return index.where(hit).select(F.explode("surfaces").alias("surface")).distinct()


def prefixes(latin: str) -> list[str]:
    """What readings may begin with for a query, without those that begin with another one."""
    every = sorted({*kana_prefixes(latin), latin.lower()} - {""}) or [""]
    kept: list[str] = []
    for p in every:
        if not (kept and p.startswith(kept[-1])):
            kept.append(p)
    return kept


def matches_many(index: DataFrame, queries: DataFrame, query: str = "query") -> DataFrame:
    """query, surface: for each different Latin query, the different surfaces whose reading begins as it may be read.

    A reading meets a query by equality on as many of its first characters as one of the query's prefixes has, so that all queries are one hashed join, and a reading is repeated by
    the number of different lengths of prefixes only. Empty and null queries match nothing.
    """

    def run(batches):
        for b in batches:
            pairs = [(q, p) for q in b.column(0).to_pylist() for p in prefixes(q)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*pairs)] or [pa.array([], pa.string())] * 2, ["query", "prefix"])

    ship(index.sparkSession)
    asked = queries.select(F.col(query).alias("query")).where("query <> ''").distinct().mapInArrow(run, "query string, prefix string")
    asked = materialized(asked.withColumn("length", F.char_length("prefix")))
    lengths = sorted(r["length"] for r in asked.select("length").distinct().collect())  # as many as prefixes have lengths
    if not lengths:
        return asked.select("query", F.col("prefix").alias("surface")).limit(0)
    heads = F.filter(F.array(*(F.struct(F.lit(n).alias("length"), F.substring("reading", 1, n).alias("prefix")) for n in lengths)), lambda x: F.char_length(x["prefix"]) == x["length"])
    readings = index.select("reading", F.explode(heads).alias("h")).select("reading", "h.length", "h.prefix")
    hits = asked.join(readings, ["length", "prefix"]).select("query", "reading")
    # Of a query's prefixes none begins with another one, so a reading is there once, and its surfaces are fetched after the join.
    return hits.join(index.select("reading", "surfaces"), "reading").select("query", F.explode("surfaces").alias("surface")).distinct()


def pattern(index: DataFrame, latin: str, most_chars: int = 10 << 20) -> str:
    """A regular expression of the query itself, its kana, and all matching surfaces. Over ``most_chars`` it raises, as nothing would compile it."""
    found = matches(index, latin)
    size = found.agg(F.sum(F.char_length("surface") + 1)).first()[0] or 0
    if size > most_chars:
        raise ValueError(f"the expression would have {size} characters")
    surfaces = [r["surface"] for r in found.collect()]  # at most most_chars
    return "|".join(re.escape(s) for s in sorted({latin, *kana_prefixes(latin), *surfaces}))
