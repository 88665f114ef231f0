"""What was written is read back, compared and searched as a whole."""

import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from lexmill.functions import text
from lexmill.operators import export, index, integrity
from lexmill.sources import files


def test_graphemes_go_by_this_python_s_marks(spark):
    every = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    extra = {*range(0x1F3FB, 0x1F400), 0x200C, 0x200D, 0xFF9E, 0xFF9F, *range(0xE0020, 0xE0080)}
    want = {c for c in every if unicodedata.category(chr(c)) in ("Mn", "Me", "Mc") or c in extra}
    near = sorted({d for c in want for d in (c - 1, c, c + 1)} | set(range(0, 0x3000, 7)) | set(range(0x10000, sys.maxunicode, 997)))
    near = [c for c in near if not 0xD800 <= c < 0xE000 and c <= sys.maxunicode]
    df = spark.createDataFrame([(c, chr(c) + "x") for c in near], "c int, s string")
    got = {r["c"] for r in df.where(text.joins_previous(F.col("s"))).collect()}
    assert got == want and len(want) > 2450
    assert spark.createDataFrame([("x́",), ("",)], "s string").where(text.joins_previous(F.col("s"))).count() == 0


def judged(spark, rows):
    return export.judged_pairs(spark.createDataFrame([(k, key, s, n) for n, (k, key, s) in enumerate(rows)], "kind string, key string, surface string, position long"))


def test_a_dictionary_in_many_files_is_read_back(spark, tmp_path):
    rows = [("ari", f"か{k}あk", f"字{x}") for k in range(60) for x in "abc"] + [("nasi", f"き{k}", f"語{x}") for k in range(60) for x in "de"]
    own, path = judged(spark, rows), str(tmp_path / "d")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        export.write_dictionary(own, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "d").glob("part-*"))) > 2
    back = export.read_dictionary(spark, path).orderBy("rank").collect()
    lines = [x for f in sorted((tmp_path / "d").glob("part-*")) for x in f.read_text().splitlines() if not x.startswith(";")]
    assert [r["surface"] for r in back] == [s for x in lines for s in x.split(" /")[1].strip("/").split("/")]
    assert export.rebuilt(own, path).count() == 0
    part = next(f for f in sorted((tmp_path / "d").glob("part-*")) if "き7 /" in f.read_text())
    part.write_text(part.read_text().replace("き7 /語d/", "き7 /語z/"))
    for crc in (tmp_path / "d").glob(".*.crc"):
        crc.unlink()
    assert {tuple(r[c] for c in ("kind", "key", "surface", "side")) for r in export.rebuilt(own, path).collect()} == {("nasi", "き7", "語d", "one"), ("nasi", "き7", "語z", "two")}
    assert {r["kind"] for r in files.read_keyed(spark, path, whole=True, splitBytes=40).where("surface IS NOT NULL AND reading LIKE 'か%'").collect()} == {"ari"}


def test_fingerprints_tell_multisets_apart(spark):
    rows = [(k % 50, f"v{k}") for k in range(400)]
    one = spark.createDataFrame(rows, "k int, v string")
    mixed = one.orderBy(F.rand(3)).repartition(5)
    assert sorted(map(tuple, integrity.fingerprints(one, "k", 16).collect())) == sorted(map(tuple, integrity.fingerprints(mixed, "k", 16).select("bucket", "n", "h1", "h2").collect()))
    assert integrity.changed_rows(one, mixed, "k").count() == 0
    twice = one.union(spark.createDataFrame([(7, "v7"), (None, None)], "k int, v string"))
    assert sorted(map(str, integrity.changed_rows(one, twice, "k").collect())) == sorted(map(str, integrity.changed_rows(one, twice, "k", buckets=1).collect()))
    got = {(r["k"], r["v"], r["side"]) for r in integrity.changed_rows(one, twice, "k").collect()}
    assert got == {(7, "v7", "two"), (None, None, "two")} and integrity.changed_rows(one.limit(0), one.limit(0), "k").count() == 0


def test_many_queries_are_each_as_one_alone(spark):
    pairs = spark.createDataFrame([("けん", "剣"), ("けんさ", "検査"), ("きゃく", "客"), ("っか", "っか"), ("kenta", "Kenta"), ("あ", "亜"), ("あい", "愛"), ("かん", "缶"), ("かんな", "鉋"), ("ん", "ん")], "reading string, surface string")
    own = index.grouped(pairs)
    asked = ["ken", "k", "kk", "a", "kanna", "n", "kya", "Ken", "zzz", "x", "あ", "ke", "a"]
    queries = spark.createDataFrame([(q,) for q in asked] + [(None,), ("",)], "query string")
    got = {}
    for r in index.matches_many(own, queries).collect():
        got.setdefault(r["query"], []).append(r["surface"])
    for q in set(asked):
        assert sorted(got.get(q, [])) == sorted(r["surface"] for r in index.matches(own, q).collect()), q
    assert set(got) <= set(asked) and index.matches_many(own, queries.limit(0)).count() == 0
    assert index.prefixes("ka") == ["か", "ka"] or set(index.prefixes("ka")) == {"か", "ka"}
    plan = index.matches_many(own, queries)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("latin", ["k", "n", "kya", "sh", "kan", "q"])
def test_no_prefix_begins_with_another(latin):
    found = index.prefixes(latin)
    every = {*index.kana_prefixes(latin), latin}
    assert all(any(p.startswith(f) for f in found) for p in every) and not any(a != b and a.startswith(b) for a in found for b in found)
