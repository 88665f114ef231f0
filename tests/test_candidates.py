import os

from lexmill.operators import export, integrity
from lexmill.runtime import keeping, materialized, shared_dir


def test_different_candidates_count_as_their_rows(spark):
    rows = [("nasi", f"k{k % 3}", ["a", "bb", "", "x/y", "cccc"][k * 7 % 5], k) for k in range(60)] + [("ari", "no", "a", 1), ("ari", "かk", "a", 2)]
    pairs = spark.createDataFrame(rows, "kind string, key string, surface string, position long")
    for cap in (5, 8, 1 << 30):
        one, two = export.judged_pairs(pairs, cap), export.judged_candidates(pairs, cap)
        counts = [{r["metric"]: r["n"] for r in export.verdict_counts(x).collect()} for x in (one, two)]
        kept = [{tuple(r) for r in x.where("verdict = 'kept'").select("kind", "key", "surface", "position").collect()} for x in (one, two)]
        assert counts[0] == counts[1] and kept[0] == kept[1] and counts[0]["input_pairs"] == 62 and two.count() == 17


def test_tables_of_nested_blocks_go_with_their_block(spark):
    folder = shared_dir(spark).removeprefix("file:")
    held = lambda: {x for x in os.listdir(folder) if x.startswith("kept-")}
    before = held()
    with keeping(spark):
        with keeping(spark):
            materialized(spark.range(3))
        assert held() == before
        materialized(spark.range(3))
        assert len(held() - before) == 1
        lasting = materialized(spark.range(4), lasting=True)
    assert held() == before and lasting.count() == 4


def test_counts_of_candidates_without_judging_each(spark):
    rows = [(kind, f"{key}", s, i) for kind, key in (("nasi", "key1"), ("nasi", "key2"), (None, "key1"), ("nasi", "bad key"), ("ari", "かくk")) for i, s in enumerate(["word", "word", "", "a/b", "other", "longer word", "x", "x"] * (3 if key == "key2" else 1))]
    pairs = spark.createDataFrame(rows, "kind string, key string, surface string, position long").repartition(3)
    for cap in (5, 12, 20, 1 << 30):
        want = {(r["metric"], r["n"]) for r in export.verdict_counts(export.judged_pairs(pairs, cap)).collect()}
        assert {(r["metric"], r["n"]) for r in export.candidate_counts(pairs, cap).collect()} == want
    assert export.candidate_counts(pairs.limit(0)).count() == 0


def test_candidates_that_fit_are_moved_once(spark):
    pairs = spark.createDataFrame([("nasi", "k", "a", 0), ("nasi", "k", "a", 1), ("nasi", "k", "b", 2)], "kind string, key string, surface string, position long")
    judged = export.judged_candidates(pairs)
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    assert sorted((r["surface"], r["n"], r["verdict"]) for r in judged.collect()) == [("a", 2, "kept"), ("b", 1, "kept")]


def test_both_sides_are_moved_once_to_compare_them(spark):
    one = spark.createDataFrame([("a", 1, 1)] * 3 + [("b", 2, 2), ("c", None, 3)], "k string, more int, side_of int")
    two = spark.createDataFrame([("a", 1, 1), ("b", 2, 2), ("d", None, 3), ("d", None, 3)], "k string, more int, side_of int")
    found = integrity.changed_rows(one, two, "k", buckets=1)
    assert found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
    assert found.columns == ["k", "more", "side_of", "side"]
    assert sorted(map(tuple, found.collect()), key=str) == [("a", 1, 1, "one")] * 2 + [("c", None, 3, "one")] + [("d", None, 3, "two")] * 2
