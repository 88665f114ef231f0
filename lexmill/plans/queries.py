"""The engine's operators over the driver's tables, each with SQL that says the same.

Words of documents serve as a lexicon: a word in small letters is a reading, the word a surface, the language a source, and
its place in the corpus the rank.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import costs as C
from ..functions import okuri, sequence, text
from ..operators import evaluate, export, index, integrity, merge, rank
from ..runtime import keeping, materialized, scratch, ship
from ..schema import ALL, ARI, GENERATED, GIVEN, NASI, SKK_ONLY
from ..sources import catalog, files, planned
from ..streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


TOK = """
parts AS (SELECT doc_id, lang, list_filter(string_split_regex(text, '[^A-Za-z]+'), lambda x: x <> '') AS p FROM documents),
tok AS (SELECT doc_id, lang, unnest(p) AS token, generate_subscripts(p, 1) - 1 AS pos FROM parts),
"""


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lang, token, pos."""
    split = F.array_remove(F.split("text", "[^A-Za-z]+"), "")
    return table(spark, sf_dir, "documents").select("doc_id", "lang", F.posexplode(split).alias("pos", "token"))


def first_tokens(spark: SparkSession, sf_dir: str, **by: Column) -> DataFrame:
    """token, lang, ``by``, with the least rank and cost (by place in the corpus) of each: words come often, so that each task folds its own before anything is made of them."""
    rank = F.col("doc_id") * 1000000 + F.col("pos")
    return tokens(spark, sf_dir).groupBy("token", "lang", *(c.alias(k) for k, c in by.items())).agg(F.min(rank).alias("rank"), F.min(F.col("pos") % 500).alias("cost"))


# Merging

LEXICON = TOK + """
lexicon AS (
  SELECT lower(token) AS reading, token AS surface, lang AS source, CASE WHEN length(token) > 12 THEN 'ari' ELSE 'nasi' END AS kind,
    CASE WHEN pos % 3 = 0 THEN 'skk' ELSE 'all' END AS scope, doc_id * 1000000 + pos AS rank, CASE WHEN pos % 5 > 0 THEN (pos % 500)::INT END AS cost,
    CASE WHEN pos % 7 = 0 THEN 'nf' || lpad((1 + pos % 48)::VARCHAR, 2, '0') END AS pri, 'p' || (pos % 4) AS pos, lower(token) AS original_reading,
    CASE WHEN doc_id % 2 = 0 THEN 'rule-generated' ELSE 'upstream-provided' END AS confidence FROM tok
),
merged AS (
  SELECT reading, surface, source, kind, CASE WHEN min(scope) = max(scope) THEN min(scope) ELSE 'all' END AS scope, min(rank) AS rank, min(cost) AS cost,
    arg_min(pri, rank) FILTER (pri IS NOT NULL) AS pri, arg_min(pos, rank) AS pos, arg_min(original_reading, rank) AS original_reading, arg_min(confidence, rank) AS confidence
  FROM lexicon GROUP BY ALL
),
"""


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows for ``merge.fold``."""
    pos, word = F.col("pos"), F.col("token")
    return tokens(spark, sf_dir).select(
        F.lower(word).alias("reading"), word.alias("surface"), F.col("lang").alias("source"), F.when(F.length(word) > 12, ARI).otherwise(NASI).alias("kind"),
        F.when(pos % 3 == 0, SKK_ONLY).otherwise(ALL).alias("scope"), (F.col("doc_id") * 1000000 + pos).alias("rank"), F.when(pos % 5 > 0, pos % 500).alias("cost"),
        F.when(pos % 7 == 0, F.array(F.concat(F.lit("nf"), F.lpad((1 + pos % 48).cast("string"), 2, "0")))).alias("pri"), F.concat(F.lit("p"), (pos % 4).cast("string")).alias("pos"),
        F.lower(word).alias("original_reading"), F.when(F.col("doc_id") % 2 == 0, GENERATED).otherwise(GIVEN).alias("confidence"), F.lit(None).cast("array<string>").alias("inf"),
    )


@query(f"WITH {LEXICON} done AS (SELECT 1) SELECT * FROM merged")
def q03_merge(spark, sf_dir):
    return merge.fold(lexicon(spark, sf_dir), often=True).withColumn("pri", F.array_join("pri", "|")).drop("inf")


@query(f"WITH {TOK} done AS (SELECT 1) SELECT DISTINCT token, lower(token) AS search_key FROM tok")
def q01_search_keys(spark, sf_dir):
    return tokens(spark, sf_dir).select("token").distinct().withColumn("search_key", text.search_key(F.col("token")))


@query(f"""
WITH {TOK} line AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'か' || doc_id || 'あk' ELSE 'key' || doc_id END AS reading, CASE WHEN doc_id % 2 = 0 THEN 'ari' ELSE 'nasi' END AS kind, coalesce(len(p), 0) AS n FROM parts)
SELECT reading, kind, CASE kind WHEN 'ari' THEN 'skk' ELSE 'all' END AS scope, token AS surface, NULL AS counter, count(*) AS n FROM line JOIN tok USING (doc_id) GROUP BY ALL
UNION ALL SELECT reading, NULL, NULL, NULL, 'skk_okuri_entry', 1 FROM line WHERE kind = 'ari'
UNION ALL SELECT reading, NULL, NULL, NULL, 'skk_special_candidate', 1 FROM line WHERE n = 0""")
def q02_keyed_files(spark, sf_dir):
    """Each document as an entry of a keyed dictionary, under the header of its section; written, and read back."""
    even = F.col("doc_id") % 2 == 0
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[^A-Za-z]+"), lambda x: x != "")
    key = F.when(even, F.concat(F.lit("か"), F.col("doc_id").cast("string"), F.lit("あk"))).otherwise(F.concat(F.lit("key"), F.col("doc_id").cast("string")))
    line = F.concat(F.when(even, files.ARI_HEADER).otherwise(files.NASI_HEADER), F.lit("\n"), key, F.lit(" /"), F.array_join(F.transform(words, lambda w: F.concat(w, F.lit(";a note"))), "/"), F.lit("/"))
    with keeping(spark), scratch(spark, "keyed") as path:
        table(spark, sf_dir, "documents").select(line).write.text(path)
        rows = files.read_keyed(spark, path)
        return materialized(rows.groupBy("reading", "kind", "scope", "surface", "counter").agg(F.count("*").alias("n")), lasting=True)


@query(f"WITH {TOK} done AS (SELECT 1) SELECT lower(token) AS reading, token AS surface, min(pos % 500)::INT AS cost FROM tok WHERE pos % 11 <> 0 GROUP BY ALL")
def q37_word_cost_files(spark, sf_dir):
    """Words as lines of word costs, of which those with a flag don't count."""
    pos, word = F.col("pos"), F.col("token")
    line = F.concat_ws("\t", F.lower(word), F.lit("7"), F.lit("8"), (pos % 500).cast("string"), word, F.when(pos % 11 == 0, "flag"))
    with scratch(spark, "costs") as path:
        tokens(spark, sf_dir).select(line).write.text(path)
        return materialized(merge.least_costs(files.read_word_costs(spark, path).where(~F.col("flagged")), ("reading", "surface")))


@query(f"WITH {TOK} done AS (SELECT 1) SELECT token || ' ' || lang AS surface, sum(pos % 90 + 1)::BIGINT AS clicks FROM tok GROUP BY ALL")
def q38_click_files(spark, sf_dir):
    """Words as lines of clicks on titles, gzipped."""
    line = F.concat_ws("\t", F.lit("other-search"), F.concat_ws("_", "token", "lang"), F.lit("external"), (F.col("pos") % 90 + 1).cast("string"))
    with scratch(spark, "clicks") as path:
        tokens(spark, sf_dir).select(line).write.option("compression", "gzip").text(path)
        return materialized(merge.total_clicks(files.read_clicks(spark, path), ("surface",), "clicks"))


@query(f"""WITH {TOK} r AS (SELECT DISTINCT lower(token) AS reading, token || chr(9) || '"' || lang AS surface FROM tok) SELECT reading, list_sort(list(surface)) AS surfaces FROM r GROUP BY reading""")
def q39_tab_pair_files(spark, sf_dir):
    """Pairs split at the first tab, quotes and further tabs kept; grouped as the index has them."""
    line = F.concat(F.lower("token"), F.lit("\t"), F.col("token"), F.lit('\t"'), F.col("lang"))
    with scratch(spark, "pairs") as path:
        tokens(spark, sf_dir).select(line).write.text(path)
        return materialized(index.grouped(files.read_tab_pairs(spark, path)))


@query(f"""WITH {TOK} done AS (SELECT 1) SELECT lower(token) AS reading, token || ' "' || lang || '"' AS surface, count(*) AS n FROM tok GROUP BY ALL""")
def q40_quoted_pair_files(spark, sf_dir):
    """Pairs in quoted fields."""
    line = F.concat(F.lower("token"), F.lit('\t"'), F.col("token"), F.lit(' ""'), F.col("lang"), F.lit('"""'))
    with scratch(spark, "quoted") as path:
        tokens(spark, sf_dir).select(line).write.text(path)
        return materialized(files.read_pairs(spark, path).groupBy("reading", "surface").agg(F.count("*").alias("n")))


@query(f"""
WITH {TOK} d AS (SELECT DISTINCT doc_id, token FROM tok), f AS (SELECT doc_id, min(token) AS first FROM d GROUP BY doc_id)
SELECT lower(token) AS reading, token AS surface, 'a noun, "common"' AS pos, token = first AS first_form, 'iK' AS inf, CASE WHEN doc_id % 2 = 0 THEN 'news1' ELSE '' END AS shared, count(*) AS n FROM d JOIN f USING (doc_id) GROUP BY ALL""")
def q41_xml_files(spark, sf_dir):
    """Each document as an XML entry: words as forms, in small letters as readings that are restricted to them, codes as entities of the DTD."""
    return xml_entries(spark, sf_dir, {})


#: Files of so many bytes of texts are there at once, some 25 times as large; then they are read, and gone. All texts take their turn.
ROUND = 1 << 28


def xml_entries(spark: SparkSession, sf_dir: str, written: dict[str, str], **options) -> DataFrame:
    words = F.array_sort(F.array_distinct(F.filter(F.split(F.coalesce("text", F.lit("")), "[^A-Za-z]+"), lambda x: x != "")))
    given = F.when(F.col("doc_id") % 2 == 0, "news1").otherwise("gai1")
    forms = F.array_join(F.transform("words", lambda w: F.concat(F.lit("<k_ele><keb>"), w, F.lit("</keb><ke_pri>news1</ke_pri><ke_inf>&iK;</ke_inf></k_ele>"))), "")
    by_reading = F.transform("words", lambda w: F.concat(F.lit("<r_ele><reb>"), F.lower(w), F.lit("</reb><re_restr>"), w, F.lit("</re_restr><re_pri>"), given, F.lit("</re_pri></r_ele>")))
    entry = F.concat(F.lit("<entry>"), forms, F.array_join(by_reading, ""), F.lit("<sense><pos>&n;</pos></sense></entry>"))
    head = """<?xml version="1.0" encoding="UTF-8"?><!DOCTYPE d [<!ENTITY n 'a noun, "common"'><!ENTITY iK "irregular kanji form">]><d>"""
    entry = F.when(F.col("n") == 0, head).when(F.col("n") == 2, "</d>").otherwise(entry)
    docs, by = table(spark, sf_dir, "documents"), ["reading", "surface", "pos", "first_form", "inf", "shared"]
    rounds = -(-(docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 1) // ROUND)
    counted = []
    with keeping(spark):
        for k in range(rounds):
            some = docs.where(F.coalesce(F.pmod(F.floor(F.col("doc_id") / 300), F.lit(rounds)), F.lit(0)) == k)
            if rounds > 1 and some.isEmpty():
                continue
            with scratch(spark, "xml") as path:  # a document of XML per file, of some hundred entries
                in_parts(some, {"n": F.lit(1)}, [{"n": F.lit(0)}, {"n": F.lit(2)}], ["n"]).withColumn("words", words).where("n <> 1 OR size(words) > 0").select("part", entry.alias("value")).write.options(**written).partitionBy("part").text(path)
                rows = files.read_xml(spark, f"{path}/*", okuri.INFLECTIONS, ranked=False, **options)
                shared = F.array_join(F.array_intersect("own_pri", "reading_pri"), "|").alias("shared")
                counted.append(materialized(rows.select(*by[:4], F.array_join("inf", "|").alias("inf"), shared).groupBy(*by).agg(F.count("*").alias("n"))))
        return materialized(reduce(DataFrame.unionByName, counted).groupBy(*by).agg(F.sum("n").alias("n")), lasting=True)


def in_parts(docs: DataFrame, own: dict[str, Column], ends: list[dict[str, Column]], order: list[str]) -> DataFrame:
    """part, doc_id, text and the columns ``own`` of documents, dealt and ordered by part, 300 ids each, and ``order``, to be written as a file a part; ``ends`` are further rows of each part.

    A part's rows run by one after the other, so that no file lies in memory, and what is made of a text is made behind the exchange.
    """
    part = F.floor(F.col("doc_id") / 300).alias("part")
    rows = docs.select(part, "doc_id", "text", *(c.alias(k) for k, c in own.items()))
    more = docs.select(part).distinct().select("part", F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), F.lit(None).cast("string").alias("text"), F.explode(F.array(*(F.struct(*(c.alias(k) for k, c in e.items())) for e in ends))).alias("e")).select("part", "doc_id", "text", "e.*")
    return rows.unionByName(more).repartition("part").sortWithinPartitions("part", *order)


@query(ORACLES["q41_xml_files"])
def q55_xml_parts(spark, sf_dir):
    """The same rows from documents dealt in parts of 64 KB."""
    return xml_entries(spark, sf_dir, {}, splitBytes=1 << 16)


@query(ORACLES["q41_xml_files"])
def q56_xml_gzipped(spark, sf_dir):
    """The same rows from gzipped documents."""
    return xml_entries(spark, sf_dir, {"compression": "gzip"})


@query(f"""
WITH {TOK} l AS (SELECT doc_id, coalesce(p, []) AS p, doc_id // 300 AS part, CASE WHEN doc_id % 300 < 150 THEN 'ari' WHEN doc_id % 11 = 0 THEN 'bad' WHEN doc_id % 7 = 0 THEN 'template' WHEN doc_id % 3 = 0 THEN 'mixed' ELSE 'plain' END AS form FROM parts),
e AS (
  SELECT *, CASE form WHEN 'ari' THEN ['skk_okuri_entry'] WHEN 'bad' THEN ['skk_malformed_entry'] WHEN 'template' THEN ['skk_template_entry'] WHEN 'mixed' THEN ['skk_expression_entry', 'skk_expression_candidate', 'skk_expression_candidate'] ELSE [] END AS c FROM l
), n AS (
  SELECT part, doc_id, form, unnest(c) AS counter, generate_subscripts(c, 1) AS k, NULL AS word FROM e
  UNION ALL SELECT part, doc_id, form, NULL, 3 + generate_subscripts(p, 1), unnest(p) FROM e WHERE form NOT IN ('bad', 'template')
  UNION ALL SELECT part, doc_id, form, 'skk_special_candidate', 4, NULL FROM e WHERE form NOT IN ('bad', 'template', 'mixed') AND len(p) = 0
)
SELECT part, CASE WHEN form = 'ari' THEN 'か' || doc_id || 'あk' WHEN form = 'template' THEN '#' || doc_id ELSE 'key' || doc_id END AS reading, word AS surface, counter, CASE WHEN word IS NOT NULL THEN CASE form WHEN 'ari' THEN 'ari' ELSE 'nasi' END END AS kind,
  CASE WHEN word IS NOT NULL THEN CASE WHEN form IN ('ari', 'mixed') THEN 'skk' ELSE 'all' END END AS scope, row_number() OVER (PARTITION BY part ORDER BY doc_id, k) - 1 AS rank FROM n""")
def q52_keyed_parts(spark, sf_dir):
    """Keyed dictionaries of two sections, with expressions, templates and broken lines, dealt in parts of 4 KB: each row's number in its file, and its section, that a part before may begin."""
    n, side = F.col("doc_id"), F.col("side")
    ari, form = n % 300 < 150, F.when(n % 300 < 150, "ari").when(n % 11 == 0, "bad").when(n % 7 == 0, "template").when(n % 3 == 0, "mixed")
    words = F.array_join(F.filter(F.split(F.coalesce("text", F.lit("")), "[^A-Za-z]+"), lambda x: x != ""), "/")
    key = F.concat(F.when(form == "ari", "か").when(form == "template", "#").otherwise("key"), n.cast("string"), F.when(form == "ari", "あk").otherwise(""))
    line = F.concat(key, F.when(form == "bad", " ").when((form == "mixed") & (words == ""), " /(f a/b)").when(form == "mixed", " /(f a/b)/").otherwise(" /"), words, F.lit("/"))
    line = F.when(side == 0, files.ARI_HEADER).when(side == 2, files.NASI_HEADER).otherwise(line)
    with keeping(spark), scratch(spark, "keyed") as path:  # some hundred documents a file
        in_parts(table(spark, sf_dir, "documents"), {"side": F.when(ari, 1).otherwise(3)}, [{"side": F.lit(0)}, {"side": F.lit(2)}], ["side", "doc_id"]).select("part", line.alias("value")).write.partitionBy("part").text(path)
        rows = files.read_keyed(spark, path, splitBytes=4096)
        return materialized(rows.select(F.regexp_extract("path", r"part=(\d+)", 1).cast("long").alias("part"), "reading", "surface", "counter", "kind", "scope", "rank"), lasting=True)


@query("""
WITH w AS (SELECT doc_id, lang, string_split_regex(coalesce(text, ''), '[^A-Za-z]+') AS p FROM documents), t AS (SELECT DISTINCT doc_id, lang, unnest(list_filter(p, lambda x: x <> '')) AS token FROM w)
SELECT lower(token) AS reading, token || '"' AS surface, '名詞|' || lang || '|*|*|*|' || CASE length(token) % 3 WHEN 0 THEN '*' WHEN 1 THEN '終止形-一般' ELSE '連用形-一般' END AS pos, CASE length(token) % 3 WHEN 2 THEN 'migemo' ELSE 'all' END AS scope, min(doc_id)::INT AS cost, count(*) AS n FROM t GROUP BY ALL""")
def q53_analyser_files(spark, sf_dir):
    """Words as rows of analyser dictionaries, quoted, with code points written out, each some hundred documents' in a zip; inflected forms are for searching only."""
    with keeping(spark), scratch(spark, "analyser") as path:
        zipped(table(spark, sf_dir, "documents"), path, lambda _: "small_lex.csv", analyser)
        rows = catalog.read(spark, {"id": "sudachi-small", "format": "sudachi", "path": path, "ranked": False})[0]
        return materialized(rows.groupBy("reading", "surface", "pos", "scope").agg(F.min("cost").alias("cost"), F.count("*").alias("n")), lasting=True)


@query("""
WITH w AS (SELECT doc_id, string_split_regex(coalesce(text, ''), '[^A-Za-z]+') AS p FROM documents), t AS (SELECT DISTINCT doc_id, unnest(list_filter(p, lambda x: x <> '')) AS token FROM w)
SELECT CASE WHEN length(token) % 5 = 0 THEN NULL ELSE lower(token) END AS reading, CASE WHEN length(token) % 5 > 0 THEN token || ' & more' END AS surface, CASE WHEN length(token) % 5 > 0 THEN 'd' || (doc_id % 4) || '_mini' END AS pos, CASE WHEN length(token) % 5 = 0 THEN 'jmed_without_reading' END AS note, count(*) AS n FROM t GROUP BY ALL""")
def q54_workbook_files(spark, sf_dir):
    """Words as cells of workbooks, four in each zip of some hundred documents, surfaces as shared strings; rows without a reading are counted."""
    with keeping(spark), scratch(spark, "books") as path:
        zipped(table(spark, sf_dir, "documents"), path, lambda doc_id: f"d{doc_id % 4}_mini.xlsx", workbook)
        rows = catalog.noted(spark, {"id": "jmed", "format": "jmed", "path": path, "ranked": False})
        given = F.col("given")
        return materialized(rows.select(F.when(given, F.col("reading")).alias("reading"), F.when(given, F.col("surface")).alias("surface"), F.when(given, F.col("pos")).alias("pos"), "note").groupBy("reading", "surface", "pos", "note").agg(F.count("*").alias("n")), lasting=True)


#: doc_id, language and different words of a document.
Words = tuple[int, str, list[str]]


def analyser(docs: list[Words]) -> bytes:
    """Rows of an analyser dictionary: surfaces in quotes, with a quote behind and their second letter as a code point."""
    forms = ("*", "終止形-一般", "連用形-一般")
    quoted = lambda w: f"{w[0]}\\u{{{ord(w[1]):x}}}{w[2:]}" if len(w) > 1 else w
    return "\n".join(f'{w},1,1,{n},"{quoted(w)}""",名詞,{lang},*,*,*,{forms[len(w) % 3]},{w.lower()},{w},*,*,*,*,*' for n, lang, words in docs for w in words).encode()


def workbook(docs: list[Words]) -> bytes:
    """A workbook of readings, of which some are -1, and surfaces under the two titles; the surfaces are shared strings."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    words = [w for _, _, own in docs for w in own]
    place = {w: k for k, w in enumerate(dict.fromkeys(words))}
    shared = "".join([f"<si><t>{w}</t><r><t> &amp; more</t></r></si>" for w in place])
    head = f'<row><c r="B1" t="inlineStr"><is><t>{planned.READING_TITLE}</t></is></c><c r="D1" t="inlineStr"><is><t>{planned.SURFACE_TITLE}</t></is></c></row>'
    rows = "".join([f'<row><c r="B{k}" t="inlineStr"><is><t>{w.lower() if len(w) % 5 else -1}</t></is></c><c r="D{k}" t="s"><v>{place[w]}</v></c></row>' for k, w in enumerate(words, 2)])
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>{shared}</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{head}{rows}</sheetData></worksheet>")
    return out.getvalue()


def zipped(docs: DataFrame, path: str, member_of: Callable[[int], str], member: Callable[[list[Words]], bytes]) -> None:
    """A zip in ``path`` for each 300 ids of documents, with their members written by ``member``. Texts are dealt, not words, and become words where they are written."""
    words = re.compile("[A-Za-z]+")

    def write(part: pd.DataFrame) -> pd.DataFrame:
        members: dict[str, list[Words]] = {}
        for n, lang, text in zip(part["doc_id"], part["lang"], part["text"]):
            if own := list(dict.fromkeys(words.findall(text))):
                members.setdefault(member_of(n), []).append((n, lang, own))
        if members:
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as z:
                for name, own in sorted(members.items()):
                    z.writestr(f"d/{name}", member(own))
            planned.put(f"{path}/{part['part'].iloc[0]}.zip", out.getvalue())
        return pd.DataFrame({"n": [len(members)]})

    ship(docs.sparkSession)
    parts = docs.select(F.floor(F.col("doc_id") / 300).alias("part"), "doc_id", "lang", F.coalesce("text", F.lit("")).alias("text"))
    parts.groupBy("part").applyInPandas(write, "n long").agg(F.sum("n")).collect()  # one number


@query("""
SELECT user_id, event_type, min(event_id) AS rank, arg_min(props, event_id) AS props, min(value) FILTER (value > 1) AS value, arg_min(value, event_id) FILTER (value > 2) AS first_large,
  CASE WHEN min(event_id % 2) = max(event_id % 2) THEN min((event_id % 2)::VARCHAR) ELSE 'all' END AS scope FROM events GROUP BY user_id, event_type""")
def q04_event_fold(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("scope", (F.col("event_id") % 2).cast("string"))
    return e.groupBy("user_id", "event_type").agg(
        F.min("event_id").alias("rank"), F.min_by("props", "event_id").alias("props"), F.min(F.when(F.col("value") > 1, F.col("value"))).alias("value"),
        merge.first_known(F.when(F.col("value") > 2, F.col("value")), F.col("event_id")).alias("first_large"), merge.widest(F.col("scope")).alias("scope"),
    )


@query("""
WITH t AS (SELECT user_id, event_id, unnest(['e' || event_type, 'v' || (event_id % 2), 'all']) AS tag FROM events), n AS (SELECT user_id, count(DISTINCT event_id) AS n FROM events GROUP BY user_id),
s AS (SELECT user_id, tag, count(DISTINCT event_id) AS k FROM t GROUP BY ALL) SELECT user_id, string_agg(tag, '|' ORDER BY tag) AS tags FROM s JOIN n USING (user_id) WHERE k = n GROUP BY user_id""")
def q05_common_tags(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    tags = F.array(F.concat(F.lit("e"), "event_type"), F.concat(F.lit("v"), (F.col("event_id") % 2).cast("string")), F.lit("all"))
    return e.withColumn("tags", tags).groupBy("user_id").agg(F.array_join(merge.common_tags(F.col("tags")), "|").alias("tags"))


@query("SELECT l_partkey, l_suppkey, min(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY ALL")
def q06_least_costs(spark, sf_dir):
    return merge.least_costs(table(spark, sf_dir, "lineitem"), ("l_partkey", "l_suppkey"), "l_extendedprice")


@query("SELECT user_id, sum((value * 100)::BIGINT)::BIGINT AS clicks FROM (SELECT user_id, floor(value) AS value FROM events) GROUP BY user_id")
def q07_total_clicks(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", (F.floor("value") * 100).cast("long").alias("v"))
    return merge.total_clicks(e, ("user_id",), "v")


@query(f"""
WITH {LEXICON} pairs AS (SELECT reading, surface, kind, max(confidence) = 'rule-generated' AS made FROM merged GROUP BY ALL)
SELECT count(DISTINCT reading) FILTER (kind = 'nasi') AS readings, count(*) FILTER (kind = 'nasi') AS nasi_pairs, count(*) FILTER (kind <> 'nasi') AS ari_pairs, count(*) FILTER (made AND kind <> 'nasi') AS generated_pairs FROM pairs""")
def q08_totals(spark, sf_dir):
    return merge.totals(merge.fold(lexicon(spark, sf_dir), often=True))


@query("""
WITH w AS (SELECT lang AS source, unnest(string_split_regex(text, '[ \\n]+')) AS surface FROM documents), r AS (SELECT source, surface, lower(surface) AS key FROM w),
m AS (SELECT source, 'parsed_pairs' AS metric FROM r UNION ALL
  SELECT source, 'unsupported_reading' FROM r WHERE NOT (surface <> '*' AND regexp_full_match(key, '[ -~]+')) UNION ALL
  SELECT source, 'invalid_surface' FROM r WHERE surface <> '*' AND regexp_full_match(key, '[ -~]+') AND (surface = '' OR regexp_matches(surface, '\\p{Cc}')))
SELECT source, metric, count(*) AS n FROM m GROUP BY ALL""")
def q09_rejects(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(F.col("lang").alias("source"), F.explode(F.split("text", r"[ \n]+")).alias("surface"))
    return merge.reject_counts(words.withColumn("reading", F.col("surface")))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def q10_selected(spark, sf_dir):
    """Rows of the sources that a selection names; one that the catalog lacks would raise."""
    orders = table(spark, sf_dir, "orders")
    listed = [{"id": r["id"]} for r in orders.select(F.col("o_orderpriority").alias("id")).distinct().orderBy("id").collect()]  # five priorities
    return orders.where(F.col("o_orderpriority").isin(catalog.select(listed, ["1-URGENT", "2-HIGH"]))).select("o_orderkey", "o_orderpriority")


@query("""
WITH c AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem), own AS (SELECT l_partkey AS t, CASE WHEN count(DISTINCT l_suppkey) = 1 THEN min(l_suppkey) END AS owner FROM lineitem WHERE l_quantity > 40 GROUP BY 1)
SELECT l_partkey AS surface, l_suppkey AS reading, CASE WHEN t IS NULL OR owner = l_suppkey THEN p_size END::BIGINT AS title_clicks FROM c LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN own ON t = l_partkey""")
def q14_owner_guard(spark, sf_dir):
    """Clicks count for a candidate unless signals give its title to another reading, or to several."""
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("surface"), F.col("l_suppkey").alias("reading"), "l_quantity")
    clicks = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("surface"), F.col("p_size").cast("long").alias("clicks"))
    said = pairs.groupBy("surface", "reading").agg(F.bool_or(F.col("l_quantity") > 40).alias("said"))
    return rank.with_guarded_clicks(said, clicks).drop("said")


@query(f"WITH {LEXICON} done AS (SELECT 1) SELECT DISTINCT reading, surface FROM merged WHERE source IN ('en', 'fr') AND kind = 'nasi' AND scope IN ('all', 'migemo')")
def q11_pairs(spark, sf_dir):
    return export.reading_pairs(merge.fold(lexicon(spark, sf_dir), often=True), ["en", "fr"])


@query(f"WITH {LEXICON} done AS (SELECT 1) SELECT reading, surface, source, original_reading, kind, scope, confidence, CASE WHEN confidence = 'rule-generated' THEN pos ELSE '' END AS rule FROM merged")
def q12_provenance(spark, sf_dir):
    return merge.provenance(merge.fold(lexicon(spark, sf_dir), often=True))


@query("SELECT l_partkey AS title, count(DISTINCT l_suppkey) AS n_owners, CASE WHEN count(DISTINCT l_suppkey) = 1 THEN min(l_suppkey) END AS owner FROM lineitem WHERE l_quantity > 40 GROUP BY 1")
def q13_owners(spark, sf_dir):
    return rank.exclusive_owner(table(spark, sf_dir, "lineitem").where("l_quantity > 40"), "l_partkey", "l_suppkey")


# Ranking

def _chain(x: str, knots) -> str:
    parts = [f"WHEN {x} <= {knots[0][0]} THEN {knots[0][1]}"]
    parts += [f"WHEN {x} <= {x1} THEN round_even({y0}::DOUBLE + {y1 - y0}::DOUBLE * ({x}::DOUBLE - {x0}) / {float(x1 - x0)}, 0)::INT" for (x0, y0), (x1, y1) in zip(knots, knots[1:])]
    return f"CASE {' '.join(parts)} WHEN {x} IS NOT NULL THEN {knots[-1][1]} END"


#: Languages as the sources that the ranking knows.
_NAMES = {"en": "skk-l", "de": "sudachi-small", "fr": "jmdict", "es": "jawiki"}
_NAME_SQL = "CASE lang " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _NAMES.items()) + " ELSE 'other' END"
RANKED = TOK + f"""
named AS (SELECT coalesce(nullif(regexp_replace(lower(token), '[aeiou]', '', 'g'), ''), lower(token)) AS reading, token AS surface, CASE WHEN doc_id % 3 = 0 THEN 'jawiki' ELSE {_NAME_SQL} END AS source, doc_id * 1000000 + pos AS rank, (pos % 500)::INT AS cost, CASE WHEN pos % 7 = 0 THEN 1 + (pos % 48) END AS nf FROM tok),
e AS (SELECT reading, surface, source, min(rank) AS rank, min(cost) AS cost, arg_min(nf, rank) FILTER (nf IS NOT NULL) AS nf FROM named GROUP BY ALL),
mz AS (SELECT reading, surface, min(1000 + (length(surface) * 797) % 12000)::INT AS cost FROM e WHERE contains(surface, 'n') GROUP BY ALL),
ck AS (SELECT surface, sum(rank % 900 + 1)::BIGINT AS clicks FROM e WHERE contains(surface, 'e') GROUP BY ALL),
sig AS (
  SELECT reading, surface FROM e WHERE source = 'skk-l' OR (source = 'sudachi-small' AND cost <> 0) OR (source = 'jmdict' AND nf IS NOT NULL) UNION SELECT reading, surface FROM mz WHERE cost >= 1000
), own AS (SELECT surface, CASE WHEN count(DISTINCT reading) = 1 THEN min(reading) END AS owner FROM sig WHERE surface IN (SELECT surface FROM ck) GROUP BY surface),
ev AS (
  SELECT reading, surface, min(rank) FILTER (source = 'skk-l') AS first_rank, min([6517, 7212, 7360, 7401, 7404, 7404, 7488, 7488][((least(nf - 1, 47)) // 6 + 1)::INT]) FILTER (source = 'jmdict' AND nf IS NOT NULL) AS tag_cost,
    min(cost) FILTER (source = 'sudachi-small' AND cost <> 0) AS measured, count(DISTINCT string_split(source, '-')[1]) AS families,
    min((CASE source WHEN 'jmdict' THEN 12000 WHEN 'sudachi-small' THEN 13000 WHEN 'jawiki' THEN 16000 ELSE 18000 END, source, rank)) AS fb
  FROM e GROUP BY ALL
), x AS (
  SELECT ev.*, mz.cost AS mz, CASE WHEN own.surface IS NULL OR own.owner = ev.reading THEN ck.clicks END AS clicks, own.surface IS NULL AS free
  FROM ev LEFT JOIN mz USING (reading, surface) LEFT JOIN ck ON ck.surface = ev.surface LEFT JOIN own ON own.surface = ev.surface
), y AS (SELECT *, CASE WHEN mz >= 1000 THEN {_chain('mz', C.MOZC_KNOTS)} ELSE least(tag_cost, measured) + 3000 END AS signal FROM x),
z AS (
  SELECT *, CASE WHEN first_rank IS NOT NULL THEN 0 WHEN surface = reading AND NOT regexp_full_match(reading, '[\\x00-\\x7F]*') THEN 2 ELSE 1 END AS tier, coalesce(clicks, 0) AS ck0,
    coalesce(signal, least(fb[1], ({_chain('clicks', C.CLICK_KNOTS)}) + 3000)) AS c FROM y
), ranked AS (
  SELECT reading, surface, signal, tier, CASE WHEN tier = 0 THEN first_rank ELSE c END AS order_cost, CASE WHEN tier = 0 THEN 0 ELSE -families END AS minus_families,
    CASE WHEN tier > 0 AND signal IS NULL THEN -ck0 ELSE 0 END AS tie_clicks, CASE WHEN tier > 0 AND signal IS NULL THEN fb[2] ELSE '' END AS tie_source,
    CASE WHEN tier > 0 AND signal IS NULL AND fb[2] = 'jawiki' THEN fb[3] ELSE 0 END AS tie_rank FROM z
), placed AS (SELECT *, row_number() OVER (PARTITION BY reading ORDER BY tier, order_cost, minus_families, tie_clicks, tie_source, tie_rank, surface) - 1 AS position FROM ranked)
"""


def named_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENTRIES: words by what is left of them without vowels."""
    lang = F.create_map(*(F.lit(x) for kv in _NAMES.items() for x in kv))
    pos, word = F.col("pos"), F.col("token")
    bare = F.regexp_replace(F.lower(word), "[aeiou]", "")
    key = F.when(bare != "", bare).otherwise(F.lower(word))
    rows = first_tokens(spark, sf_dir, third=F.col("doc_id") % 3 == 0, nf=F.when(pos % 7 == 0, 1 + pos % 48)).select(
        key.alias("reading"), word.alias("surface"), F.when(F.col("third"), "jawiki").otherwise(F.coalesce(F.try_element_at(lang, F.col("lang")), F.lit("other"))).alias("source"),
        F.lit(NASI).alias("kind"), F.lit(ALL).alias("scope"), "rank", "cost", F.when(F.col("nf").isNotNull(), F.array(F.concat(F.lit("nf"), F.lpad(F.col("nf").cast("string"), 2, "0")))).alias("pri"),
        F.lit("").alias("pos"), key.alias("original_reading"), F.lit(GIVEN).alias("confidence"), F.lit(None).cast("array<string>").alias("inf"),
    )
    return merge.fold(rows)


def ordered(merged: DataFrame, ignored: tuple[str, ...] = ()) -> DataFrame:
    costs = merged.where(F.contains("surface", F.lit("n"))).select("reading", "surface", (1000 + (F.length("surface") * 797) % 12000).cast("int").alias("cost"))
    clicks = merged.where(F.contains("surface", F.lit("e"))).select("surface", (F.col("rank") % 900 + 1).alias("clicks"))
    return rank.nasi_order(merged, [*_NAMES.values(), "other"], costs, clicks, ["jawiki"], ignored=ignored)


def ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank.positions(ordered(materialized(named_lexicon(spark, sf_dir))))


@query(f"WITH {RANKED} SELECT reading, surface, signal::INT AS signal, tier::INT AS tier, order_cost::BIGINT AS order_cost, minus_families::BIGINT AS minus_families, tie_clicks::BIGINT AS tie_clicks, tie_source, tie_rank::BIGINT AS tie_rank, position::INT AS position FROM placed")
def q15_ranking(spark, sf_dir):
    return ranking(spark, sf_dir)


@query(f"WITH {RANKED} SELECT reading, surface, position::INT AS position FROM placed WHERE position < 8")
def q35_top(spark, sf_dir):
    return evaluate.top(ranking(spark, sf_dir)).select("reading", "surface", "position")


#: The order without the first source's evidence; what only that source has stands behind all.
_BEHIND = "(1, 18001, 0, 0, '', 0, surface)"
AGREED = RANKED.replace("AS fb\n  FROM e GROUP BY ALL", "AS fb\n  FROM e WHERE source <> 'skk-l' GROUP BY ALL")


@query(f"""
WITH {AGREED}, firsts AS (SELECT reading, surface, min(rank) AS rank FROM e GROUP BY ALL), truth AS (
  SELECT reading, surface, row_number() OVER (PARTITION BY reading ORDER BY rank, surface) - 1 AS position FROM firsts QUALIFY count(*) OVER (PARTITION BY reading) > 1
), seen AS (
  SELECT reading, surface, truth.position, signal, CASE WHEN tier IS NULL THEN {_BEHIND} ELSE (tier, order_cost, minus_families, tie_clicks, tie_source, tie_rank, surface) END AS place FROM truth LEFT JOIN ranked USING (reading, surface)
), pairs AS (
  SELECT position, surface, place, signal, lead(surface) OVER w AS nxt, lead(place) OVER w AS nxt_place, lead(signal) OVER w AS nxt_signal FROM seen WINDOW w AS (PARTITION BY reading ORDER BY position)
), n AS (SELECT position, place < nxt_place AS agree, surface < nxt AS lexical, signal IS NOT NULL AND nxt_signal IS NOT NULL AS signal FROM pairs WHERE nxt IS NOT NULL),
s AS (SELECT 'adjacent' AS scope, * FROM n UNION ALL SELECT 'first-two', * FROM n WHERE position = 0)
SELECT scope, count(*) AS n, count(*) FILTER (agree) AS agree, count(*) FILTER (lexical) AS lexical, count(*) FILTER (signal) AS signal, count(*) FILTER (signal AND agree) AS signal_agree FROM s GROUP BY scope""")
def q23_agreement(spark, sf_dir):
    """How far the order without one source agrees with the candidates' order in the corpus; some candidates only that source has."""
    merged = materialized(named_lexicon(spark, sf_dir))
    return evaluate.evaluate_order(merged, ordered(merged, ("skk-l",)))["agreement"]


@query(f"""
WITH {TOK} g AS (SELECT DISTINCT lower(token) AS key, substr(token, 1, 3) AS stem, lang AS source, 'c' || (length(token) % 5) AS class FROM tok WHERE lang IN ('de', 'fr')),
t AS (SELECT DISTINCT lower(token) AS key, substr(token, 1, 3) AS stem FROM tok WHERE lang = 'en'), b AS (SELECT DISTINCT substr(key, 1, length(key) - 1) AS bare, stem FROM t), k AS (SELECT DISTINCT key FROM t),
l AS (SELECT DISTINCT key, stem, 'source' AS grouping, source AS label FROM g UNION SELECT DISTINCT key, stem, 'class', class FROM g UNION SELECT DISTINCT key, stem, 'source/class', source || ' ' || class FROM g),
m AS (SELECT l.*, k.key IS NOT NULL AS known, t.key IS NOT NULL AS hit, b.bare IS NOT NULL AS stemmed FROM l LEFT JOIN t ON t.key = l.key AND t.stem = l.stem LEFT JOIN k ON k.key = l.key LEFT JOIN b ON b.bare = substr(l.key, 1, length(l.key) - 1) AND b.stem = l.stem)
SELECT grouping, label, count(*) AS pairs, count(*) FILTER (known) AS key_known, count(*) FILTER (known AND hit) AS hits, count(*) FILTER (stemmed) AS stem_known, count(*) FILTER (stemmed AND hit) AS stem_hits FROM m GROUP BY ALL""")
def q19_rule_precision(spark, sf_dir):
    t = tokens(spark, sf_dir).select(F.lower("token").alias("key"), F.substring("token", 1, 3).alias("stem"), F.col("lang").alias("source"), F.concat(F.lit("c"), (F.length("token") % 5).cast("string")).alias("class"))
    return evaluate.rule_precision(t.where(F.col("source").isin("de", "fr")), t.where(F.col("source") == "en")).drop("low", "high")


@query("""
WITH c AS (SELECT event_type, count(*) FILTER (value > 50) AS h, count(*) AS n FROM events GROUP BY event_type), p AS (SELECT *, h / n::DOUBLE AS p, 1.96::DOUBLE AS z FROM c)
SELECT event_type, h AS hits, n, round((p + z*z/(2*n) - z*sqrt(p*(1-p)/n + z*z/(4.0*n*n))) / (1 + z*z/n), 6) AS low, round((p + z*z/(2*n) + z*sqrt(p*(1-p)/n + z*z/(4.0*n*n))) / (1 + z*z/n), 6) AS high, format('{:.3f} ({:,}/{:,})', p, h, n) AS ratio FROM p""")
def q25_wilson(spark, sf_dir):
    c = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count_if(F.col("value") > 50).alias("hits"), F.count("*").alias("n"))
    low, high = evaluate.wilson(F.col("hits"), F.col("n"))
    return c.withColumn("low", F.round(low, 6)).withColumn("high", F.round(high, 6)).withColumn("ratio", evaluate.ratio_text(F.col("hits"), F.col("n")))


@query(f"SELECT doc_id, ({_chain('n_chars', C.MOZC_KNOTS)})::INT AS word_cost, ({_chain('n_chars', C.CLICK_KNOTS)})::INT AS click_cost FROM documents")
def q26_interpolated(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", C.mozc_cost(F.col("n_chars")).alias("word_cost"), C.click_cost(F.col("n_chars")).alias("click_cost"))


@query("""
WITH q AS (SELECT quantile_cont(l_extendedprice, [0.01, 0.25, 0.5, 0.75, 0.99]) AS x, quantile_cont(l_quantity, [0.01, 0.25, 0.5, 0.75, 0.99]) AS y FROM lineitem),
p AS (SELECT unnest(x) AS x, unnest(list_reverse(y)) AS y, generate_subscripts(x, 1) - 1 AS n FROM q), l AS (SELECT *, lag(x) OVER (ORDER BY n) AS b FROM p)
SELECT n::INT AS n, round(x, 4) AS x, round(y, 4) AS y FROM l WHERE b IS NULL OR b <> x""")
def q27_knots(spark, sf_dir):
    return evaluate.knots(table(spark, sf_dir, "lineitem"), "l_extendedprice", "l_quantity", (0.01, 0.25, 0.5, 0.75, 0.99), falling=True).select("n", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


@query("""
WITH m AS (SELECT l_linenumber AS band, quantile_cont(l_extendedprice, 0.5) AS m, count(*) AS n FROM lineitem GROUP BY 1),
c AS (SELECT a.band AS first, b.band AS last, sum(x.m * x.n) / sum(x.n) AS mean FROM m a JOIN m b ON b.band >= a.band JOIN m x ON x.band BETWEEN a.band AND b.band GROUP BY ALL)
SELECT m.band, round((SELECT max(low) FROM (SELECT first, min(mean) AS low FROM c WHERE last >= m.band AND first <= m.band GROUP BY first)), 6) AS median FROM m""")
def q57_pooled_medians(spark, sf_dir):
    """The median of each band, made to never fall: at each band the greatest over all starts of the least mean to any end."""
    found = evaluate.pooled_medians(table(spark, sf_dir, "lineitem"), "l_linenumber", "l_extendedprice")
    return spark.createDataFrame(found, "band int, median double").withColumn("median", F.round("median", 6))


@query(f"WITH {LEXICON} done AS (SELECT 1) SELECT * FROM merged")
def q58_incremental_merge(spark, sf_dir):
    """The merged lexicon from a store that was folded in three batches, the last rows first."""
    rows = lexicon(spark, sf_dir)
    with scratch(spark, "store") as path:
        store = incremental.Store(spark, path, buckets=16)
        for k in (2, 1, 0):
            store.fold(rows.where(F.col("rank") % 3 == k), often=True)
        return materialized(store.entries().withColumn("pri", F.array_join("pri", "|")).drop("inf"))


# Order, output, integrity

LINES = "lines AS (SELECT doc_id, unnest(p) AS line, generate_subscripts(p, 1) - 1 AS line_no FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)),"


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


@query(f"WITH {LINES} m AS (SELECT *, CASE WHEN length(line) < 60 THEN line END AS header FROM lines) SELECT doc_id, line_no::INT AS line_no, last_value(header IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS section FROM m")
def q21_sections(spark, sf_dir):
    marked = lines(spark, sf_dir).withColumn("header", F.when(F.length("line") < 60, F.col("line")))
    return marked.select("doc_id", "line_no", sequence.carry_forward(F.col("header"), "doc_id", "line_no").alias("section"))


@query(f"""
WITH RECURSIVE {LINES} f(doc_id, line_no, size, fits) AS (
  SELECT doc_id, -1::BIGINT, 10, false FROM documents UNION ALL
  SELECT f.doc_id, l.line_no, CASE WHEN f.size + length(l.line) + 1 <= 2000 THEN f.size + length(l.line) + 1 ELSE f.size END, f.size + length(l.line) + 1 <= 2000 FROM f JOIN lines l ON l.doc_id = f.doc_id AND l.line_no = f.line_no + 1
) SELECT doc_id, line_no::INT AS line_no, fits FROM f WHERE line_no >= 0""")
def q22_greedy_fit(spark, sf_dir):
    sized = lines(spark, sf_dir).select("doc_id", "line_no", F.char_length("line").alias("length"))
    return export.greedy_fit(sized, ["doc_id"], "line_no", F.col("length") + 1, F.lit(10), 2000).drop("length")


@query(f"""
WITH RECURSIVE {LINES} j AS (SELECT doc_id, line_no, line, line = '' OR regexp_matches(line, '[/;#\\[\\]]') OR line LIKE '(%' AS bad, row_number() OVER (PARTITION BY doc_id, line ORDER BY line_no) > 1 AS again FROM lines),
g AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS k FROM j WHERE NOT bad AND NOT again), f(doc_id, k, size, fits) AS (
  SELECT doc_id, 0::BIGINT, 3 + length(doc_id::VARCHAR), false FROM documents UNION ALL
  SELECT f.doc_id, g.k, CASE WHEN f.size + length(g.line) + 1 <= 900 THEN f.size + length(g.line) + 1 ELSE f.size END, f.size + length(g.line) + 1 <= 900 FROM f JOIN g ON g.doc_id = f.doc_id AND g.k = f.k + 1
), v AS (SELECT 'input_pairs' AS metric FROM j UNION ALL SELECT 'unsafe_candidate_pairs' FROM j WHERE bad UNION ALL SELECT 'duplicate_pairs' FROM j WHERE NOT bad AND again
  UNION ALL SELECT CASE WHEN fits THEN 'nasi_pairs' ELSE 'overlong_entry_pairs' END FROM f WHERE k > 0 UNION ALL SELECT 'nasi_readings' FROM (SELECT DISTINCT doc_id FROM f WHERE fits))
SELECT metric, count(*) AS n FROM v GROUP BY metric""")
def q51_capped_entries(spark, sf_dir):
    """Lines as candidates of their document's key, of which some entries are too long."""
    rows = lines(spark, sf_dir).select(F.lit(NASI).alias("kind"), F.concat(F.lit("key"), F.col("doc_id").cast("string")).alias("key"), F.col("line").alias("surface"), F.col("line_no").alias("position"))
    return export.verdict_counts(export.judged_pairs(rows, cap=900))


@query("""
WITH p AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'ari' ELSE 'nasi' END AS kind, doc_id // 10 AS k, string_split_regex(text, '[ \\n]+') AS w FROM documents),
r AS (SELECT kind, CASE WHEN kind = 'ari' THEN 'か' || k || 'あk' ELSE 'key' || k END AS key, unnest(w) AS surface, generate_subscripts(w, 1) - 1 AS i FROM p), d AS (SELECT kind, key, surface, min(i) AS i, count(*) AS n FROM r GROUP BY ALL)
SELECT 'input_pairs' AS metric, sum(n)::BIGINT AS n FROM d UNION ALL SELECT 'unsafe_candidate_pairs', sum(n)::BIGINT FROM d WHERE surface = '' OR regexp_matches(surface, '[/;#\\[\\]]') OR surface LIKE '(%'
UNION ALL SELECT 'duplicate_pairs', sum(n - 1)::BIGINT FROM d WHERE NOT (surface = '' OR regexp_matches(surface, '[/;#\\[\\]]') OR surface LIKE '(%') AND n > 1 HAVING sum(n - 1) > 0
UNION ALL SELECT kind || '_pairs', count(*) FROM d WHERE NOT (surface = '' OR regexp_matches(surface, '[/;#\\[\\]]') OR surface LIKE '(%') GROUP BY kind
UNION ALL SELECT kind || '_readings', count(DISTINCT key) FROM d WHERE NOT (surface = '' OR regexp_matches(surface, '[/;#\\[\\]]') OR surface LIKE '(%') GROUP BY kind""")
def q36_verdicts(spark, sf_dir):
    kind, k = F.when(F.col("doc_id") % 2 == 0, ARI).otherwise(NASI), F.floor(F.col("doc_id") / 10).cast("string")
    d = table(spark, sf_dir, "documents").select(kind.alias("kind"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("か"), k, F.lit("あk"))).otherwise(F.concat(F.lit("key"), k)).alias("key"), "doc_id", F.posexplode(F.split("text", r"[ \n]+")).alias("i", "surface"))
    with keeping(spark):
        return materialized(export.candidate_counts(d.select("kind", "key", "surface", (F.col("doc_id") * 1_000_000 + F.col("i")).alias("position")), cap=1 << 30), lasting=True)


@query("SELECT doc_id, sha256(text) AS sha256 FROM documents")
def q30_digests(spark, sf_dir):
    return integrity.row_digests(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("""
WITH l AS (SELECT doc_id, sha256(text) AS h FROM documents), r AS (SELECT doc_id, sha256(trim(lower(text))) AS h FROM documents WHERE lang <> 'fr' UNION ALL SELECT -1 - doc_id, sha256(lang) FROM documents WHERE lang = 'fr')
SELECT doc_id, CASE WHEN l.h IS NULL THEN 'missing' WHEN r.h IS NULL THEN 'unlisted' ELSE 'changed' END AS problem FROM l FULL JOIN r USING (doc_id) WHERE l.h IS NULL OR r.h IS NULL OR l.h <> r.h""")
def q31_listing(spark, sf_dir):
    """Documents against a list in which one language's have other names, and texts are in small letters."""
    d = table(spark, sf_dir, "documents")
    french = F.col("lang") == "fr"
    listed = d.select(F.when(french, -1 - F.col("doc_id")).otherwise(F.col("doc_id")).alias("doc_id"), F.when(french, F.col("lang")).otherwise(F.trim(F.lower("text"))).alias("text"))
    return integrity.differences(integrity.row_digests(d, "doc_id", "text"), integrity.row_digests(listed, "doc_id", "text"), "doc_id")


@query(f"""
WITH {TOK} r AS (SELECT DISTINCT lower(token) AS reading, token AS surface, CASE lang WHEN 'en' THEN 'skk' WHEN 'de' THEN 'sudachi' ELSE 'jmdict' END AS kind FROM tok),
s AS (SELECT reading, surface, list_sort(list(kind)) AS kinds FROM r GROUP BY ALL), m AS (SELECT 'candidates_' || CASE WHEN list_contains(kinds, 'skk') THEN 'skk' ELSE array_to_string(kinds, '+') END AS metric FROM s
  UNION ALL SELECT 'keys' FROM (SELECT DISTINCT reading FROM s) UNION ALL SELECT 'keys_with_upstream' FROM (SELECT DISTINCT reading FROM r WHERE kind = 'skk'))
SELECT metric, count(*) AS n FROM m GROUP BY metric""")
def q32_origins(spark, sf_dir):
    lang = F.col("lang")
    source = F.when(lang == "en", "skk-l").when(lang == "de", "sudachi-core").otherwise("jmdict")
    rows = tokens(spark, sf_dir).select(F.lower("token").alias("reading"), F.col("token").alias("surface"), source.alias("source"), F.lit(ARI).alias("kind"), F.lit(SKK_ONLY).alias("scope"), F.when(lang == "en", GIVEN).otherwise(GENERATED).alias("confidence"))
    return rank.origins(rows, ["skk-l", "sudachi-core", "jmdict"])


@query(f"WITH {TOK} done AS (SELECT 1) SELECT DISTINCT token AS surface FROM tok WHERE starts_with(lower(token), 'the')")
def q33_prefix_search(spark, sf_dir):
    pairs = tokens(spark, sf_dir).select(F.lower("token").alias("reading"), F.col("token").alias("surface"))
    return index.matches(index.grouped(pairs), "the")


@query(f"""
WITH {TOK} d AS (SELECT DISTINCT lower(token) AS word, token AS surface FROM tok), r AS (SELECT word AS reading, surface FROM d UNION SELECT translate(word, 'aiueo', 'あいうえお'), surface FROM d),
q AS (SELECT DISTINCT word AS query, word AS key FROM d UNION SELECT DISTINCT regexp_extract(word, '^[aiueo]+'), regexp_extract(word, '^[aiueo]+') FROM d),
k AS (SELECT query, key FROM q WHERE query <> '' UNION SELECT query, translate(query, 'aiueo', 'あいうえお') FROM q WHERE regexp_full_match(query, '[aiueo]+')),
p AS (SELECT surface, substr(reading, 1, n) AS head FROM (SELECT surface, reading, unnest(range(1, length(reading) + 1)) AS n FROM r))
SELECT query, count(DISTINCT surface) AS n, min(surface) AS first, max(surface) AS last FROM k JOIN p ON head = key GROUP BY query""")
def q59_many_latin_queries(spark, sf_dir):
    """Every word and every run of vowels that a word begins with as a query, against readings in letters and with vowels in kana."""
    words = tokens(spark, sf_dir).select(F.lower("token").alias("word"), F.col("token").alias("surface")).distinct()
    both = words.select("word", "surface", F.explode(F.array("word", F.translate("word", "aiueo", "あいうえお"))).alias("reading"))
    queries = words.select(F.explode(F.array("word", F.regexp_extract("word", "^[aiueo]+", 0))).alias("query"))
    found = index.matches_many(materialized(index.grouped(both)), queries)
    return found.groupBy("query").agg(F.count("*").alias("n"), F.min("surface").alias("first"), F.max("surface").alias("last"))


@query(f"""
WITH {TOK} e AS (SELECT DISTINCT CASE WHEN doc_id % 2 = 0 THEN 'ari' ELSE 'nasi' END AS kind, CASE WHEN doc_id % 2 = 0 THEN 'か' || doc_id || 'あk' ELSE 'key' || doc_id END AS key, token AS surface, lang FROM tok),
l AS (SELECT DISTINCT kind, key, CASE WHEN lang = 'fr' THEN upper(surface) ELSE surface END AS surface FROM e), d AS (SELECT kind, key, surface FROM e)
SELECT *, 'one' AS side FROM (SELECT * FROM l EXCEPT SELECT * FROM d) UNION ALL SELECT *, 'two' FROM (SELECT * FROM d EXCEPT SELECT * FROM l)""")
def q60_rebuilt_dictionary(spark, sf_dir):
    """A dictionary of both sections, written, read back, and compared with candidates of which one language's are in capitals."""
    even, n = F.col("doc_id") % 2 == 0, F.col("doc_id").cast("string")
    rows = tokens(spark, sf_dir).select(F.when(even, ARI).otherwise(NASI).alias("kind"), F.when(even, F.concat(F.lit("か"), n, F.lit("あk"))).otherwise(F.concat(F.lit("key"), n)).alias("key"), F.col("token").alias("surface"), "lang", F.col("pos").alias("position"))
    changed = rows.withColumn("surface", F.when(F.col("lang") == "fr", F.upper("surface")).otherwise(F.col("surface")))
    with keeping(spark), scratch(spark, "dictionary") as path:
        judged = [export.judged_candidates(r.drop("lang"), cap=1 << 30) for r in (rows, changed)]
        export.write_dictionary(judged[0], path)
        with keeping(spark):
            written = materialized(export.read_dictionary(spark, path).drop("rank"))  # read once, compared twice
            if not export.unlike(judged[0], written).isEmpty():
                raise ValueError("the dictionary isn't what its candidates make")
            return materialized(export.unlike(judged[1], written), lasting=True)


@query()
def q34_normalized(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.search_key(F.col("text")).alias("search_key"))


@query("""
SELECT l_partkey AS reading, l_suppkey AS surface, least AS word_cost, least IS NULL AS absent FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)
LEFT JOIN (SELECT l_partkey, l_suppkey, min(l_extendedprice) AS least FROM lineitem WHERE l_quantity > 25 GROUP BY ALL) USING (l_partkey, l_suppkey)""")
def q18_absence(spark, sf_dir):
    """The least cost of each pair, and whether it lacks one."""
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("reading"), F.col("l_suppkey").alias("surface"), F.col("l_extendedprice").alias("cost"), "l_quantity")
    return rank.with_least_cost(pairs.select("reading", "surface").distinct(), pairs.where("l_quantity > 25")).withColumn("absent", F.col("word_cost").isNull())


@query("""
WITH r AS (SELECT p_brand AS reading, p_type AS surface, CASE WHEN p_size < 15 THEN 'skk-l' WHEN p_size < 30 THEN 'sudachi-small' WHEN p_size < 40 THEN 'sudachi-core' ELSE 'jmdict' END AS source, p_partkey AS rank, p_size AS cost, p_retailprice > 1400 AS odd FROM part)
SELECT reading, surface, min(rank) FILTER (source = 'skk-l') AS first_rank, min(cost) FILTER (source = 'sudachi-small' AND cost <> 0)::INT AS measured_cost, bool_or(source = 'jmdict') AS is_tagged,
  coalesce(bool_and(odd) FILTER (source = 'jmdict'), false) AS irregular, count(DISTINCT string_split(source, '-')[1]) AS families,
  min((CASE source WHEN 'jmdict' THEN 12000 WHEN 'skk-l' THEN 18000 ELSE 13000 END, source, rank))[3] AS fallback_rank FROM r GROUP BY ALL""")
def q20_evidence(spark, sf_dir):
    """Rows of many sources as one row of evidence per pair: leasts, flags, counts, and the least tuple."""
    size = F.col("p_size")
    rows = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("reading"), F.col("p_type").alias("surface"), F.when(size < 15, "skk-l").when(size < 30, "sudachi-small").when(size < 40, "sudachi-core").otherwise("jmdict").alias("source"),
        F.col("p_partkey").alias("rank"), size.alias("cost"), F.lit(None).cast("array<string>").alias("pri"), (F.col("p_retailprice") > 1400).alias("irregular"),
    )
    ids = ["skk-l", "sudachi-small", "sudachi-core", "jmdict"]
    return rank.evidence(rows, ids, ids).select("reading", "surface", "first_rank", "measured_cost", "is_tagged", "irregular", F.col("families").cast("long").alias("families"), "fallback_rank")


#: Words as ari candidates: two languages' are given, two languages' are generated, with the dictionary form that they come from.
ARI_ROWS = TOK + """
a AS (
  SELECT lower(token) || 'k' AS reading, upper(substr(token, 1, 1)) || CASE WHEN pos % 2 = 0 THEN lang ELSE token END AS surface, CASE lang WHEN 'en' THEN 'skk-l' WHEN 'de' THEN 'sudachi-small' WHEN 'fr' THEN 'jmdict' ELSE 'jawiki' END AS source,
    doc_id * 1000000 + pos AS rank, (pos % 500)::INT AS cost, lower(token) AS base FROM tok
), ar AS (SELECT reading, surface, source, min(rank) AS rank, min(cost) AS cost, arg_min(base, rank) AS base FROM a GROUP BY ALL),
given AS (SELECT reading, surface, min(((source <> 'skk-l')::INT, CASE source WHEN 'jawiki' THEN 3 ELSE 0 END, rank)) AS place FROM ar WHERE source IN ('skk-l', 'jawiki') GROUP BY ALL),
made AS (
  SELECT reading, surface, min(cost) FILTER (source = 'sudachi-small' AND cost <> 0) AS measured, count(DISTINCT string_split(source, '-')[1]) AS families,
    min((CASE source WHEN 'jmdict' THEN 12000 ELSE 13000 END, source, rank)) AS fb FROM ar WHERE source IN ('sudachi-small', 'jmdict') GROUP BY ALL
), both_tiers AS (
  SELECT reading, surface, -1 AS tier, place[1]::BIGINT AS a, place[2]::BIGINT AS b, place[3] AS c, '' AS d FROM given
  UNION ALL SELECT reading, surface, 1, coalesce(measured, fb[1]), -families, 0, CASE WHEN measured IS NULL THEN fb[2] ELSE '' END FROM made ANTI JOIN given USING (reading, surface)
), ari_placed AS (SELECT reading, surface, tier, row_number() OVER (PARTITION BY reading ORDER BY tier, a, b, c, d, surface) - 1 AS position FROM both_tiers)
"""


def ari_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    word, lang = F.col("token"), F.col("lang")
    source = F.when(lang == "en", "skk-l").when(lang == "de", "sudachi-small").when(lang == "fr", "jmdict").otherwise("jawiki")
    rows = first_tokens(spark, sf_dir, even=F.col("pos") % 2 == 0).select(
        F.concat(F.lower(word), F.lit("k")).alias("reading"), F.concat(F.upper(F.substring(word, 1, 1)), F.when(F.col("even"), lang).otherwise(word)).alias("surface"), source.alias("source"), F.lit(ARI).alias("kind"), F.lit(SKK_ONLY).alias("scope"),
        "rank", "cost", F.lit(None).cast("array<string>").alias("pri"), F.concat(F.lit("okuri-rule|v5k|"), F.lower(word), F.lit("|"), word).alias("pos"),
        F.lower(word).alias("original_reading"), F.when(lang.isin("de", "fr"), GENERATED).otherwise(GIVEN).alias("confidence"), F.lit(None).cast("array<string>").alias("inf"),
    )
    return merge.fold(rows)


def ari_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = ["skk-l", "sudachi-small", "jmdict", "jawiki"]
    return rank.positions(rank.ari_order(ari_lexicon(spark, sf_dir), ids, {s: k for k, s in enumerate(ids)}))


@query(f"WITH {ARI_ROWS} SELECT reading, surface, tier::INT AS tier, position::INT AS position FROM ari_placed")
def q16_two_tiers(spark, sf_dir):
    """Given candidates by source and rank, then the generated ones that aren't given, by cost."""
    return ari_positions(spark, sf_dir).select("reading", "surface", "tier", "position")


@query(f"""
WITH {ARI_ROWS}, nasi AS (SELECT lower(token) AS key, token AS surface, min(doc_id * 1000000 + pos) AS rank FROM tok GROUP BY ALL), p AS (SELECT 'nasi' AS kind, key, surface, row_number() OVER (PARTITION BY key ORDER BY rank, surface) - 1 AS position FROM nasi)
SELECT kind, key, surface, position::INT AS position FROM p UNION ALL SELECT 'ari', reading, surface, position::INT FROM ari_placed""")
def q42_dictionary_order(spark, sf_dir):
    """Both sections of a dictionary, one behind the other."""
    word, none = F.col("token"), F.lit(None).cast("array<string>")
    rows = first_tokens(spark, sf_dir).select(
        F.lower(word).alias("reading"), word.alias("surface"), F.lit("skk-l").alias("source"), F.lit(NASI).alias("kind"), F.lit(ALL).alias("scope"), "rank", "cost", none.alias("pri"), F.lit("").alias("pos"),
        F.lower(word).alias("original_reading"), F.lit(GIVEN).alias("confidence"), none.alias("inf"),
    )
    given = merge.fold(rows)
    return export.ranked_pairs(ari_positions(spark, sf_dir), rank.positions(rank.nasi_order(given, ["skk-l"])))


_DIGITS, _KATAKANA, _HIRAGANA = "0123456789", "カキクケコサシスセソ", "かきくけこさしすせそ"


@query(f"""
WITH r AS (
  SELECT p_brand AS reading, translate((p_size % 20)::VARCHAR, '{_DIGITS}', '{_KATAKANA}') AS surface, translate(p_size::VARCHAR, '{_DIGITS}', '{_KATAKANA}') AS original_reading, CASE WHEN p_retailprice > 1200 THEN 'jmdict' ELSE 'jawiki' END AS source,
    p_partkey AS rank, p_size::INT AS cost, CASE WHEN p_retailprice > 1300 THEN 'nf01' END AS pri, false AS irregular FROM part
), k AS (SELECT DISTINCT reading, surface AS spelling FROM r), m AS (SELECT r.*, source = 'jmdict' AND pri IS NOT NULL AND original_reading <> surface AND spelling IS NOT NULL AS moved FROM r LEFT JOIN k ON k.reading = r.reading AND k.spelling = r.original_reading)
SELECT reading, surface, source, rank, cost, CASE WHEN NOT moved THEN pri END AS pri, irregular FROM m UNION ALL SELECT reading, original_reading, source, rank, NULL, pri, false FROM m WHERE moved""")
def q17_loanwords(spark, sf_dir):
    """Tags of a loanword go to the spelling of its reading, where that is a candidate of the same key."""
    kana = lambda c: F.translate(c.cast("string"), _DIGITS, _KATAKANA)
    rows = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("reading"), kana(F.col("p_size") % 20).alias("surface"), kana(F.col("p_size")).alias("original_reading"), F.when(F.col("p_retailprice") > 1200, "jmdict").otherwise("jawiki").alias("source"),
        F.col("p_partkey").alias("rank"), F.col("p_size").cast("int").alias("cost"), F.when(F.col("p_retailprice") > 1300, F.array(F.lit("nf01"))).alias("pri"), F.lit(False).alias("irregular"),
    )
    return rank.move_loanword_tags(rows).withColumn("pri", F.array_join("pri", "|"))


@query(f"""
WITH {TOK} g AS (SELECT DISTINCT lower(token) AS key, token AS stem, lang AS source, 'c' || (length(token) % 5) AS class FROM tok WHERE lang IN ('es', 'fr')),
t AS (SELECT DISTINCT lower(token) AS key, token AS stem FROM tok WHERE lang = 'en'), b AS (SELECT DISTINCT substr(key, 1, length(key) - 1) AS bare, stem FROM t), k AS (SELECT DISTINCT key FROM t),
l AS (SELECT DISTINCT key, stem, 'source' AS grouping, source AS label FROM g UNION SELECT DISTINCT key, stem, 'class', class FROM g UNION SELECT DISTINCT key, stem, 'source/class', source || ' ' || class FROM g UNION SELECT DISTINCT key, stem, 'letter', right(key, 1) FROM g),
m AS (SELECT l.*, k.key IS NOT NULL AS known, t.key IS NOT NULL AS hit, b.bare IS NOT NULL AS stemmed FROM l LEFT JOIN t ON t.key = l.key AND t.stem = l.stem LEFT JOIN k ON k.key = l.key LEFT JOIN b ON b.bare = substr(l.key, 1, length(l.key) - 1) AND b.stem = l.stem)
SELECT grouping, label, count(*) AS pairs, count(*) FILTER (known) AS key_known, count(*) FILTER (known AND hit) AS hits, count(*) FILTER (stemmed) AS stem_known, count(*) FILTER (stemmed AND hit) AS stem_hits FROM m GROUP BY ALL""")
def q24_groupings(spark, sf_dir):
    """Precision by four groupings at once, the key's last letter among them."""
    t = tokens(spark, sf_dir).select(F.lower("token").alias("key"), F.col("token").alias("stem"), F.col("lang").alias("source"), F.concat(F.lit("c"), (F.length("token") % 5).cast("string")).alias("class"))
    return evaluate.evaluate_rules(t.where(F.col("source").isin("es", "fr")), t.where(F.col("source") == "en"), by_letter=True)["by_group"].drop("low", "high")


@query(f"""
WITH {TOK} g AS (SELECT DISTINCT lower(token) AS key, token AS stem, lang AS source, 'c' || (length(token) % 5) AS class FROM tok WHERE lang IN ('es', 'fr')), o AS (SELECT key, stem, string_agg(DISTINCT source || ':' || class, ' ' ORDER BY source || ':' || class) AS labels FROM g WHERE key NOT IN (SELECT lower(token) FROM tok WHERE lang = 'en') GROUP BY ALL)
SELECT key, stem, labels FROM o ORDER BY sha256('0' || chr(9) || key || chr(9) || stem), key, stem LIMIT 50""")
def q43_sample(spark, sf_dir):
    """A seeded sample of generated pairs whose key isn't known."""
    t = tokens(spark, sf_dir).select(F.lower("token").alias("key"), F.col("token").alias("stem"), F.col("lang").alias("source"), F.concat(F.lit("c"), (F.length("token") % 5).cast("string")).alias("class"))
    return evaluate.evaluate_rules(t.where(F.col("source").isin("es", "fr")), t.where(F.col("source") == "en"), sample=50)["sample"]


_LATIN, _HIRA, _KATA = "abcdefghijklmnopqrstuvwxyz", "あいうえおかきくけこさしすせそたちつてとなにぬねのは", "アイウエオカキクケコサシスセソタチツテトナニヌネノハ"


@query(f"""
WITH {TOK} c AS (
  SELECT translate(lower(token), 'aeiou', 'あえいおう') AS reading, CASE pos % 3 WHEN 0 THEN token WHEN 1 THEN translate(lower(token), '{_LATIN}', '{_HIRA}') ELSE translate(lower(token), '{_LATIN}', '{_KATA}') END AS surface, doc_id * 1000000 + pos AS rank FROM tok
), f AS (SELECT reading, surface, min(rank) AS rank FROM c GROUP BY ALL), h AS (SELECT reading, min(surface) AS lexical, arg_min(surface, rank) AS ordered FROM f GROUP BY reading HAVING count(*) > 1),
e AS (SELECT 'lexical' AS label, lexical AS s FROM h WHERE NOT regexp_full_match(reading, '[\x00-\x7F]*') UNION ALL SELECT 'ordered', ordered FROM h WHERE NOT regexp_full_match(reading, '[\x00-\x7F]*'))
SELECT label, CASE WHEN regexp_full_match(s, '[\x00-\x7F]*') THEN 'ascii' WHEN regexp_full_match(s, '[ぁ-ゖ]+') THEN 'hiragana' ELSE 'katakana' END AS kind, count(*) AS n FROM e GROUP BY ALL""")
def q28_first_kinds(spark, sf_dir):
    """What stands first in keys that aren't ASCII, by code points and by rank."""
    low, pos = F.lower("token"), F.col("pos")
    surface = F.when(pos % 3 == 0, F.col("token")).when(pos % 3 == 1, F.translate(low, _LATIN, _HIRA)).otherwise(F.translate(low, _LATIN, _KATA))
    rows = tokens(spark, sf_dir).select(F.translate(low, "aeiou", "あえいおう").alias("reading"), surface.alias("surface"), (F.col("doc_id") * 1000000 + pos).alias("rank"))
    return evaluate.first_kinds(evaluate.truth_order(rows))


@query(f"""
WITH p AS (SELECT p_partkey, translate(p_partkey::VARCHAR, '{_DIGITS}', '{_HIRAGANA}') AS kana, p_size % 3 AS k FROM part), l AS (SELECT * FROM (VALUES (0, 'k'), (0, 'i'), (1, 'r'), (1, 'y'), (1, 't'), (1, 'n'), (1, 'm'), (2, 'i'), (2, 'k'), (2, 's')) AS t(k, letter))
SELECT p_partkey, kana || letter AS okuri_key, ['書', '見', '高'][k + 1] AS stem FROM p JOIN l USING (k)""")
def q44_inflected(spark, sf_dir):
    """Dictionary forms of three classes as keys and stems of their inflected forms."""
    kana, k = F.translate(F.col("p_partkey").cast("string"), _DIGITS, _HIRAGANA), F.col("p_size") % 3
    by = lambda *v: F.when(k == 0, v[0]).when(k == 1, v[1]).otherwise(v[2])
    forms = table(spark, sf_dir, "part").select("p_partkey", by("書く", "見る", "高い").alias("surface"), F.concat(kana, by("く", "る", "い")).alias("reading"), by("v5k", "v1", "adj-i").alias("class"))
    return okuri.inflect(forms).select("p_partkey", "okuri_key", "stem")


@query(f"""
WITH p AS (SELECT translate(p_partkey::VARCHAR, '{_DIGITS}', '{_HIRAGANA}') AS kana, p_size AS cost FROM part)
SELECT kana || letter AS reading, '書' AS surface, 'okuri-rule|五段-カ行|' || kana || 'く|書く' AS pos, cost::INT AS cost FROM p, (VALUES ('k'), ('i')) AS t(letter)""")
def q45_lemmas(spark, sf_dir):
    """Analyser rows, of each lemma the plain form and another one, as generated entries."""
    kana = F.translate(F.col("p_partkey").cast("string"), _DIGITS, _KATAKANA)
    form = lambda name, surface, tail, cost: F.struct(F.lit(name).alias("form"), F.lit(surface).alias("surface"), F.concat(kana, F.lit(tail)).alias("reading"), cost.cast("int").alias("cost"))
    size = F.col("p_size")
    forms = F.explode(F.array(form(okuri.PLAIN_FORM, "書く", "ク", size), form("連用形-イ音便", "書い", "イ", size + 5), form("仮定形-一般", "描け", "ケ", size))).alias("f")
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("lemma"), F.lit("五段-カ行").alias("conjugation"), F.lit("書く").alias("normalized"), forms).select("lemma", "conjugation", "normalized", "f.*")
    return okuri.from_lemmas(rows)[0].select("reading", "surface", "pos", "cost")


@query("SELECT p_partkey, chr(12353 + p_size::INT) || 'x' || chr(131072 + p_partkey::INT) AS plain FROM part")
def q46_unescaped(spark, sf_dir):
    code = lambda c: F.lower(F.hex(c.cast("long")))
    escaped = F.concat(F.lit("\\u"), F.lpad(code(F.col("p_size") + 12353), 4, "0"), F.lit("x\\u{"), code(F.col("p_partkey") + 131072), F.lit("}"))
    return table(spark, sf_dir, "part").select("p_partkey", text.unescape_code_points(escaped).alias("plain"))


@query("SELECT p_partkey, lower(p_name) AS reading, p_type || '|' || p_brand AS surface FROM part")
def q47_dictionary_forms(spark, sf_dir):
    """The dictionary forms that generated rows name."""
    pos = F.concat_ws("|", F.lit("okuri-rule"), F.lit("v5k"), "p_name", "p_type", "p_brand")
    return table(spark, sf_dir, "part").select("p_partkey", okuri.base_of(pos).alias("b")).select("p_partkey", "b.reading", "b.surface")


@query(f"""
WITH {LEXICON} done AS (SELECT 1), s AS (SELECT * FROM (VALUES ('en', '1', 'A'), ('de', '2', 'B')) AS t(source, version, license))
SELECT reading, surface, source, original_reading, kind, scope, confidence, CASE WHEN confidence = 'rule-generated' THEN pos ELSE '' END AS rule, version, license FROM merged LEFT JOIN s USING (source)""")
def q48_traced(spark, sf_dir):
    """Each entry with its source's version and licence; two sources aren't listed."""
    listed = [{"id": "en", "format": "skk", "version": "1", "license": "A"}, {"id": "de", "format": "skk", "version": "2", "license": "B"}]
    return merge.traced(merge.fold(lexicon(spark, sf_dir), often=True), catalog.source_table(spark, listed))


@query(f"WITH {LEXICON} done AS (SELECT 1), i AS (SELECT unnest(['en', 'de', 'fr', 'es', 'none']) AS id) SELECT id, count(reading) AS n, count(*) FILTER (confidence = 'rule-generated') AS generated FROM i LEFT JOIN merged ON source = id GROUP BY id")
def q49_per_source(spark, sf_dir):
    """Entries by source, of listed ones that have none, too."""
    return merge.per_source(merge.fold(lexicon(spark, sf_dir), often=True), ["en", "de", "fr", "es", "none"])


@query("""
WITH l AS (SELECT o_orderkey AS line_no, CASE WHEN o_orderkey % 1000 < 600 THEN 'ari' ELSE 'nasi' END AS kind, o_orderpriority AS key FROM orders)
SELECT b.line_no, b.kind, b.key FROM l a JOIN l b ON b.line_no = a.line_no + 1 WHERE (a.kind <> b.kind OR a.key <> b.key) AND ((a.kind = 'nasi' AND b.kind = 'ari') OR (a.kind = b.kind AND ((b.key > a.key) = (b.kind = 'ari'))))""")
def q50_order_errors(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return export.order_errors(o.select(F.col("o_orderkey").alias("line_no"), F.when(F.col("o_orderkey") % 1000 < 600, ARI).otherwise(NASI).alias("kind"), F.col("o_orderpriority").alias("key")))


@query("WITH l AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity > 49 OR l_quantity < 2), p AS (SELECT p_partkey AS k FROM part WHERE p_size > 10) (SELECT k FROM p EXCEPT ALL SELECT k FROM l) UNION ALL (SELECT k FROM l EXCEPT ALL SELECT k FROM p)")
def q29_differs(spark, sf_dir):
    """Rows that one of two relations has and the other lacks."""
    sold = table(spark, sf_dir, "lineitem").where("l_quantity > 49 OR l_quantity < 2").select(F.col("l_partkey").alias("k")).distinct()
    return integrity.differs(table(spark, sf_dir, "part").where("p_size > 10").select(F.col("p_partkey").alias("k")), sold)

