import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.functions import quantiles
from lexmill.operators import evaluate, export, merge
from lexmill.schema import ENTRIES
from lexmill.streaming import incremental


def rows_of(spark, n=300, seed=1):
    r = random.Random(seed)
    made = []
    for k in range(n):
        pri, inf = r.choice([None, None, ["nf01"], ["nf02", "a"]]), r.choice([None, ["iK"], ["iK", "ok"], ["iK", "rK"], ["ok"]])
        made.append((f"r{r.randrange(40)}", f"s{r.randrange(3)}", f"x{r.randrange(2)}", r.choice(["nasi", "ari"]), r.choice(["all", "skk", "migemo"]), k, r.choice([None, r.randrange(99)]), pri, f"p{k}", f"o{k}", f"c{k}", inf))
    return spark.createDataFrame(made, "reading string, surface string, source string, kind string, scope string, rank long, cost int, pri array<string>, pos string, original_reading string, confidence string, inf array<string>")


def equal(a, b):
    b = b.select(a.columns)
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_batches_in_any_order_and_twice(spark, tmp_path):
    rows = rows_of(spark).cache()
    want = merge.fold(rows)
    for seed in (0, 1):
        store = incremental.Store(spark, str(tmp_path / f"s{seed}"), buckets=8)
        assert store.manifest() is None and store.entries().count() == 0
        order = [0, 1, 2, 3]
        random.Random(seed).shuffle(order)
        for k in [*order, order[1]]:
            store.fold(rows.where(F.col("rank") % 4 == k))
        assert equal(store.entries(), want) and store.entries().schema == ENTRIES and store.manifest()["version"] == 5
        assert store.fold(rows.limit(0)) == [] and store.manifest()["version"] == 5


def test_a_small_batch_rewrites_its_buckets_only(spark, tmp_path):
    store = incremental.Store(spark, str(tmp_path / "s"), buckets=16)
    rows = rows_of(spark)
    store.fold(rows)
    before = store.manifest()["folders"]
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "s" / "data").rglob("*.parquet")}
    touched = store.fold(rows.where("reading = 'r7'").withColumn("cost", F.lit(-1)))
    after = store.manifest()["folders"]
    assert len(touched) == 1 and {b for b in after if after[b] != before[b]} == {str(touched[0])} and incremental.Store(spark, str(tmp_path / "s"), buckets=3).buckets == 16
    assert all(p.stat().st_mtime_ns == t for p, t in files.items())  # old files are as they were, so the old version is still there
    assert store.entries(1).where("cost = -1").count() == 0 < store.entries().where("cost = -1").count() and equal(store.entries(1), merge.fold(rows))
    assert store.vacuum() == 1 and equal(store.entries().where("reading <> 'r7'"), merge.fold(rows).where("reading <> 'r7'")) and store._versions() == [2]
    assert store.vacuum() == 0


def test_a_batch_that_fails_leaves_the_store(spark, tmp_path, monkeypatch):
    store = incremental.Store(spark, str(tmp_path / "s"), buckets=4)
    rows = rows_of(spark)
    store.fold(rows.where("rank < 200"))
    with monkeypatch.context() as m:
        m.setattr(incremental, "_move", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            store.fold(rows.where("rank >= 200"))
    assert store.manifest()["version"] == 1 and equal(store.entries(), merge.fold(rows.where("rank < 200")))
    with pytest.raises(OSError, match="is there already"):
        store._commit(store.manifest())
    store.fold(rows.where("rank >= 200"))
    assert equal(store.entries(), merge.fold(rows)) and store.vacuum() > 0 and equal(store.entries(), merge.fold(rows))


@pytest.mark.parametrize("values", [
    list(np.random.default_rng(1).normal(size=3000)), [5.0] * 500 + [7.0], [1e308, -1e308, 0.0, 1e-308, 5e-324], list(np.random.default_rng(2).integers(0, 4, 900).astype(float)), [1 + k * 2.0**-52 for k in range(300)], [3.0],
])
def test_quantiles_are_exact(spark, values):
    shares = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double").repartition(3)
    got = quantiles.quantiles(df, "v", shares)[None]
    assert np.allclose(got, np.quantile(values, shares), rtol=1e-13, atol=0)
    ranks = sorted({0, len(values) - 1, len(values) // 2})
    found = quantiles.order_statistics(df, "v", {None: ranks})
    assert [found[None, r] for r in ranks] == [sorted(values)[r] for r in ranks]


def test_quantiles_of_groups_and_of_nothing(spark):
    r = np.random.default_rng(3)
    rows = [(g, float(v)) for g in ("a", "b", None) for v in r.exponential(size=200)] + [("empty", None)]
    got = quantiles.quantiles(spark.createDataFrame(rows, "g string, v double"), "v", (0.1, 0.9), by="g")
    assert set(got) == {"a", "b", None} and all(np.allclose(got[g], np.quantile([v for x, v in rows if x == g and v is not None], (0.1, 0.9))) for g in got)
    blank = spark.createDataFrame([], "v double, w double")
    assert quantiles.quantiles(blank, "v", (0.5,)) == {} and evaluate.knots(blank, "v", "w").count() == 0
    with pytest.raises(ValueError, match="has 0 values"):
        quantiles.order_statistics(blank, "v", {None: [0]})
    plan = evaluate.knots(spark.range(50).selectExpr("id AS x", "id * 2 AS y"), "x", "y")
    assert "percentile" not in plan._jdf.queryExecution().toString() and [tuple(r) for r in plan.collect()][0] == (0, 0.49, 0.98)


def test_pooled_blocks_of_parts_are_those_of_the_whole():
    r = random.Random(4)
    for _ in range(50):
        points = [([k], r.gauss(k / 9, 2), r.randint(1, 5)) for k in range(r.randint(1, 40))]
        whole = evaluate.pool(points)
        cut = r.randrange(len(points) + 1)
        parts = evaluate.pool([*evaluate.pool(points[:cut]), *evaluate.pool(points[cut:])])
        assert [b[0] for b in parts] == [b[0] for b in whole] and np.allclose([b[1] for b in parts], [b[1] for b in whole])
        assert all(a[1] <= b[1] for a, b in zip(whole, whole[1:])) and sum(b[2] for b in whole) == sum(p[2] for p in points)


def test_greedy_fit_against_a_loop(spark):
    r = random.Random(5)
    rows = [(r.choice(["a", "b", None, "cc"]), k, r.randint(0, 12)) for k in range(2000)]
    want, size = {}, {}
    for key, k, n in rows:
        used = size.setdefault(key, len(key or ""))
        want[k] = used + n <= 900
        size[key] += n * want[k]
    df = spark.createDataFrame(rows, "key string, k int, n int").repartition(5)
    got = export.greedy_fit(df, ["key"], "k", F.col("n"), F.char_length(F.coalesce("key", F.lit(""))), 900)
    assert got.columns == ["key", "k", "n", "fits"] and {x["k"]: x["fits"] for x in got.collect()} == want and export.greedy_fit(df.limit(0), ["key"], "k", F.col("n"), F.lit(0), 9).count() == 0
    with pytest.raises(ValueError, match="in use: fits"):
        export.greedy_fit(df.withColumn("fits", F.lit(1)), ["key"], "k", F.col("n"), F.lit(0), 9)


def test_a_key_of_a_million_candidates_is_linear(spark):
    hot = spark.range(1_000_000).select(F.lit("nasi").alias("kind"), F.lit("key").alias("key"), F.concat(F.lit("w"), F.col("id").cast("string")).alias("surface"), F.col("id").alias("position"))
    began = time.time()
    counts = {r["metric"]: r["n"] for r in export.verdict_counts(export.judged_pairs(hot)).collect()}
    assert counts["input_pairs"] == 1_000_000 and counts["nasi_pairs"] + counts["overlong_entry_pairs"] == 1_000_000 and counts["nasi_pairs"] > 4000
    assert time.time() - began < 120


def test_rows_that_come_often_fold_to_the_same_entries(spark, tmp_path):
    rows = [(f"r{k % 3}", f"s{k % 4}", "x", "nasi", "all" if k % 5 else "skk", k, k % 7, ["nf01"] if k % 3 == 1 else None, f"p{k % 2}", "o", "upstream-provided", ["t"] if k % 2 else None) for k in range(240)]
    df = spark.createDataFrame(rows, ENTRIES)
    one, two = incremental.Store(spark, str(tmp_path / "one"), 4), incremental.Store(spark, str(tmp_path / "two"), 4)
    for k in (2, 0, 1):
        one.fold(df.where(f"rank % 3 = {k}"))
        two.fold(df.where(f"rank % 3 = {k}"), often=True)
    assert one.entries().count() == 12 and sorted(map(str, one.entries().collect())) == sorted(map(str, two.entries().collect()))
