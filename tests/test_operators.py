import io
import json
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from lexmill.operators import evaluate, export, index, integrity, merge, rank
from lexmill.schema import ENTRIES


def entries(spark, rows):
    """(reading, surface, source, rank[, cost[, pri[, kind[, original[, inf[, confidence[, pos]]]]]]])."""
    full = []
    for r in rows:
        reading, surface, source, place, cost, pri, kind, original, inf, confidence, pos = (*r, *[None] * (11 - len(r)))
        full.append((reading, surface, source, kind or "nasi", "all", place, cost, pri, pos or "", original or reading, confidence or "upstream-provided", inf))
    return spark.createDataFrame(full, ENTRIES)


def order(spark, rows, key=None, **more):
    ids = sorted({r[2] for r in rows})
    return [r["surface"] for r in rank.positions(rank.nasi_order(entries(spark, rows), ids, **more)).where(F.col("reading") == (key or rows[0][0])).orderBy("position").collect()]


def test_fold(spark):
    rows = [
        ("あ", "亜", "s", "nasi", "migemo", 3, None, None, "first", "ア", "c1", ["iK", "ok"]), ("あ", "亜", "s", "nasi", "all", 5, 30, ["nf02"], "second", "あ", "c2", ["iK"]), ("あ", "亜", "s", "nasi", "migemo", 9, 20, ["nf01"], "third", "あ", "c3", ["iK", "rK"]),
        ("い", "胃", "s", "nasi", "skk", 1, None, None, "", "い", "c", ["iK"]), ("い", "胃", "s", "nasi", "skk", 2, None, None, "", "い", "c", None),
    ]
    df = spark.createDataFrame(rows, "reading string, surface string, source string, kind string, scope string, rank long, cost int, pri array<string>, pos string, original_reading string, confidence string, inf array<string>")
    for seed in range(3):
        mixed = df.orderBy(F.rand(seed)).repartition(3)
        got = {r["reading"]: r for r in merge.fold(mixed).collect()}
        a, i = got["あ"], got["い"]
        assert (a["scope"], a["rank"], a["cost"], a["pri"], a["pos"], a["original_reading"], a["confidence"], a["inf"]) == ("all", 3, 20, ["nf02"], "first", "ア", "c1", ["iK"])
        assert (i["scope"], i["cost"], i["pri"], i["inf"]) == ("skk", None, None, None)
    assert merge.fold(df.limit(0)).count() == 0


def test_counts(spark):
    merged = entries(spark, [("あ", "亜", "a", 0), ("あ", "亜", "b", 0, None, None, None, None, None, "rule-generated"), ("い", "胃", "b", 1, None, None, "ari", None, None, "rule-generated")])
    assert merge.totals(merged).first().asDict() == {"readings": 1, "nasi_pairs": 1, "ari_pairs": 1, "generated_pairs": 1}
    assert {tuple(r) for r in merge.per_source(merged, ["a", "b", "c"]).collect()} == {("a", 1, 0), ("b", 2, 2), ("c", 0, 0)}


def test_first_source_then_costs(spark):
    rows = [
        ("か", "可", "skk-l", 5), ("か", "課", "skk-l", 2), ("か", "蚊", "sudachi-small", 0, 8000), ("か", "科", "jmdict", 0, None, ["news1", "nf01"]), ("か", "佳", "jawiki", 0), ("か", "火", "jmdict", 1), ("か", "カ", "skk-geo", 0), ("か", "ka", "skk-geo", 1), ("か", "か", "skk-geo", 2),
        ("か", "果", "jmdict", 3, None, None, None, None, ["iK"]),
    ]
    expected = ["課", "可", "科", "蚊", "火", "佳", "果", "カ", "ka", "か"]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        assert order(spark, rows, shift_without_costs=False) == expected


def test_word_costs_rank_and_add_nothing(spark):
    rows = [("か", "蚊", "sudachi-small", 0, 5000), ("か", "科", "jmdict", 0, None, ["nf01"]), ("か", "佳", "jawiki", 0)]
    costs = spark.createDataFrame([("か", "佳", 3000), ("か", "無", 10), ("か", "蚊", 6000)], "reading string, surface string, cost int")
    assert order(spark, rows, costs=costs) == ["佳", "蚊", "科"]


def test_missing_word_costs_shift_as_the_export_does(spark):
    rows = [("か", "蚊", "sudachi-small", 0, 10000), ("か", "科", "jmdict", 0)]
    assert order(spark, rows) == ["科", "蚊"] and order(spark, rows, shift_without_costs=False) == ["蚊", "科"]


def test_clicks_and_owners(spark):
    rows = [("しゃとう", "沙棠", "jmed", 0), ("しゃとう", "車塔", "jawiki", 0), ("つき", "月", "sudachi-small", 0, 5000), ("ひかる", "月", "jmnedict", 0), ("ひかる", "光", "jmnedict", 1)]
    clicks = spark.createDataFrame([("沙棠", 400), ("月", 10**6), ("光", 20)], "surface string, clicks long")
    got = {(r["reading"], r["surface"]): r for r in rank.nasi_order(entries(spark, rows), ["jmed", "jawiki", "sudachi-small", "jmnedict"], clicks=clicks, shift_without_costs=False).collect()}
    assert got["しゃとう", "沙棠"]["order_cost"] == 8972 and got["ひかる", "月"]["order_cost"] == 15000 and got["ひかる", "光"]["order_cost"] < 12000
    shifted = {(r["reading"], r["surface"]): r["order_cost"] for r in rank.nasi_order(entries(spark, rows), ["jmed", "jawiki"], clicks=clicks).collect()}
    assert shifted["しゃとう", "沙棠"] == 11972


def test_loanword_tags_move(spark):
    rows = [("こーひー", "珈琲", "jmdict", 0, None, ["gai1"], None, "コーヒー"), ("こーひー", "コーヒー", "sudachi-small", 0, 9000), ("こーひー", "可否", "sudachi-small", 1, 8500)]
    assert order(spark, rows, shift_without_costs=False) == ["コーヒー", "可否", "珈琲"]


def test_ari(spark):
    rows = [
        ("かk", "書", "skk-x", 0, None, None, "ari"), ("かk", "欠", "skk-l", 9, None, None, "ari"), ("かk", "掻", "sudachi-small", 0, 7000, None, "ari", None, None, "rule-generated", "okuri-rule|五段|カク|掻く"), ("かk", "描", "jmdict", 0, None, ["nf01"], "ari", None, None, "rule-generated", "okuri-rule|v5k|カク|描く"),
        ("かk", "書", "sudachi-small", 0, 10, None, "ari", None, None, "rule-generated", "okuri-rule|五段|カク|書く"),
    ]
    merged, ids = entries(spark, rows), ["skk-l", "skk-x", "sudachi-small", "jmdict"]
    listed = lambda **k: [r["surface"] for r in rank.positions(rank.ari_order(merged, ids, {s: n for n, s in enumerate(ids)}, **k)).orderBy("position").collect()]
    assert listed() == ["欠", "書", "描", "掻"]
    assert listed(costs=spark.createDataFrame([("かく", "掻く", 2000)], "reading string, surface string, cost int")) == ["欠", "書", "掻", "描"]
    assert {tuple(r) for r in rank.origins(merged, ids).collect()} == {("keys", 1), ("keys_with_upstream", 1), ("candidates_skk", 2), ("candidates_sudachi", 1), ("candidates_jmdict", 1)}


def pairs(spark, rows):
    return spark.createDataFrame([(k, key, v, n) for n, (k, key, v) in enumerate(rows)], "kind string, key string, surface string, position long")


def test_dictionary(spark, tmp_path):
    rows = [("ari", "わr", "割"), ("ari", "かk", "書"), ("ari", "かk", "書"), ("nasi", "あ", "亜"), ("nasi", "あ", "a/b"), ("nasi", "あ", "長い候補"), ("nasi", "あ", "胃"), ("nasi", "い う", "x"), ("nasi", "いk", "x")]
    judged = export.judged_pairs(pairs(spark, rows), cap=7)
    assert {r["metric"]: r["n"] for r in export.verdict_counts(judged).collect()} == {"input_pairs": 9, "ari_pairs": 2, "nasi_pairs": 2, "ari_readings": 2, "nasi_readings": 1, "duplicate_pairs": 1, "unsafe_candidate_pairs": 1, "unsupported_key_pairs": 2, "overlong_entry_pairs": 1}
    path = str(tmp_path / "d")
    assert export.write_dictionary(judged, path)["pairs"] == 4
    lines = [line for f in sorted((tmp_path / "d").glob("part-*")) for line in f.read_text().splitlines()]
    assert lines[1:] == [";; okuri-ari entries.", "わr /割/", "かk /書/", ";; okuri-nasi entries.", "あ /亜/胃/"]
    listed = json.loads(export.manifest(spark, path, [{"id": "a"}, {"id": "b"}], ["a"], note=1))
    assert listed["sources"] == [{"id": "a"}] and listed["note"] == 1 and all(len(f["sha256"]) == 64 for f in listed["files"])
    with pytest.raises(ValueError):
        export.write_dictionary(judged.where("false"), path)
    assert lines == [line for f in sorted((tmp_path / "d").glob("part-*")) for line in f.read_text().splitlines()]
    with pytest.raises(ValueError, match="No pairs"):
        export.write_pairs(judged.where("false"), path)


def test_order_errors(spark):
    good = [("ari", "b"), ("ari", "a"), ("nasi", "a"), ("nasi", "a"), ("nasi", "b")]
    frame = lambda rows: spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], "line_no long, kind string, key string")
    assert export.order_errors(frame(good)).count() == 0
    for bad in ([("ari", "a"), ("ari", "b")], [("nasi", "b"), ("nasi", "a")], [("nasi", "a"), ("ari", "a")]):
        assert export.order_errors(frame(bad)).count() == 1


def test_index(spark, tmp_path):
    rows = [("けんさく", "検索"), ("けんさく", "研削"), ("けんさく", "検索"), ("おしかつ", "推し活"), ("せいせい", "生成"), ("けん", "剣"), ("けんa", "x+y")]
    listed = spark.createDataFrame(rows, "reading string, surface string")
    path = str(tmp_path / "i")
    index.build(listed, path)
    assert index.lookup(spark, path, "けんさく") == ["検索", "研削"] and index.lookup(spark, path, "ない") == []
    built = spark.read.parquet(path)
    assert {r[0] for r in index.matches(built, "kens").collect()} == {"検索", "研削"}
    assert {r[0] for r in index.matches(built, "oshikatsu").collect()} == {"推し活"} and {r[0] for r in index.matches(built, "seisei").collect()} == {"生成"}
    assert {r[0] for r in index.matches(built, "ken").collect()} == {"検索", "研削", "剣", "x+y"}
    assert r"x\+y" in index.pattern(built, "ken").split("|") and index.differences(listed, built).count() == 0
    with pytest.raises(ValueError):
        index.pattern(built, "ken", most_chars=3)
    assert index.kana_prefixes("kk") == sorted("っ" + k for s, k in index.syllables().items() if s.startswith("k")) or "っか" in index.kana_prefixes("kk")


def test_evaluation(spark):
    truth = evaluate.truth_order(spark.createDataFrame([("か", "亜", 0), ("か", "吾", 1), ("か", "亜", 2), ("か", "唖", 3), ("き", "x", 0)], "reading string, surface string, rank long"))
    assert [tuple(r) for r in truth.orderBy("position").collect()] == [("か", "亜", 0), ("か", "吾", 1), ("か", "唖", 2)]
    ranked = rank.nasi_order(entries(spark, [("か", "亜", "sudachi-small", 0, 9000), ("か", "吾", "sudachi-small", 0, 8000)]), ["sudachi-small"])
    got = {r["scope"]: tuple(r)[1:] for r in evaluate.order_agreement(truth, ranked).collect()}
    assert got == {"adjacent": (2, 1, 2, 1, 0), "first-two": (1, 0, 1, 1, 0)}
    t = spark.createDataFrame([("かk", "書"), ("わr", "割")], "key string, stem string")
    g = spark.createDataFrame([("かk", "書", "s", "v5"), ("かk", "欠", "s", "v5"), ("かi", "書", "j", "v5"), ("xk", "y", "j", "v1")], "key string, stem string, source string, class string")
    got = {(r["grouping"], r["label"]): (r["pairs"], r["key_known"], r["hits"], r["stem_known"], r["stem_hits"]) for r in evaluate.rule_precision(g, t, by_letter=True).collect()}
    assert got["source", "s"] == (2, 2, 1, 1, 1) and got["class", "v5"] == (3, 2, 1, 2, 1) and got["source/class", "j v1"] == (1, 0, 0, 0, 0) and got["letter", "k"] == (3, 2, 1, 1, 1)
    low, high = spark.range(1).select(*evaluate.wilson(F.lit(9), F.lit(10))).first()
    assert (round(low, 4), round(high, 4)) == (0.5958, 0.9821) and tuple(spark.range(1).select(*evaluate.wilson(F.lit(0), F.lit(0))).first()) == (0.0, 1.0)
    bands = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 7.0), (4, 10.0)], "band int, v double")
    assert evaluate.pooled_medians(bands, "band", "v") == [(1, 5.0), (2, 8.0), (3, 8.0), (4, 10.0)]
    kinds = spark.createDataFrame([("か", "科", 0), ("か", "カ", 1), ("a", "b", 0), ("a", "c", 1)], "reading string, surface string, position int")
    assert {tuple(r) for r in evaluate.first_kinds(kinds).collect()} == {("lexical", "katakana", 1)}


def tar(members):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return out.getvalue()


def test_archives(spark, tmp_path):
    import hashlib

    files = [("r/a", b"1"), ("r/b", b"2")]
    sums = json.dumps({n[2:]: hashlib.sha256(d).hexdigest() for n, d in files}).encode()
    problems = lambda members, **k: {tuple(r) for r in integrity.verify_archive(spark, str(tmp_path / "t") if (tmp_path / "t").write_bytes(tar(members)) else "", **k).collect()}
    listed = ("r/" + integrity.LIST, sums)
    assert problems([*files, listed]) == set()
    assert problems([files[0], ("r/b", b"x"), listed], required=("c",)) == {("b", "changed"), ("c", "missing")}
    assert ("../e", "unsafe") in problems([*files, listed, ("../e", b"")])
    folder = tmp_path / "f"
    (folder / "d").mkdir(parents=True)
    (folder / "d/a").write_bytes(b"1")
    (folder / integrity.LIST).write_text(json.dumps({"d/a": hashlib.sha256(b"1").hexdigest()}))
    assert integrity.verify_folder(spark, str(folder)).count() == 0
    (folder / "d/b").write_bytes(b"2")
    assert [tuple(r) for r in integrity.verify_folder(spark, str(folder)).collect()] == [("d/b", "unlisted")]


def test_rules_against_a_truth(spark):
    made = spark.createDataFrame([("かk", "書", "a", "v5k"), ("かk", "書", "b", "v5k"), ("みr", "見", "a", "v1"), ("zz", "字", "a", "v1"), ("yy", "字", "b", "v1")], "key string, stem string, source string, class string")
    truth = spark.createDataFrame([("かk", "書"), ("みr", "観"), ("みr", "観")], "key string, stem string")
    out = evaluate.evaluate_rules(made, truth, by_letter=True, sample=1)
    total = out["total"].first()
    assert (total["pairs"], total["key_known"], total["hits"], total["truth"], total["precision"], total["recall"]) == (4, 2, 1, 2, "0.500 (1/2)", "0.500 (1/2)")
    assert {r["grouping"] for r in out["by_group"].collect()} == {"source", "class", "source/class", "letter"}
    drawn = [evaluate.evaluate_rules(made, truth, sample=1)["sample"].collect() for _ in range(2)]
    assert drawn[0] == drawn[1] and drawn[0][0]["key"] in ("zz", "yy")


def test_archive_round_trip(spark, tmp_path):
    (tmp_path / "stage" / "sub").mkdir(parents=True)
    (tmp_path / "stage" / "a.txt").write_text("one")
    (tmp_path / "stage" / "sub" / "b.txt").write_text("two")
    listed = integrity.write_archive(spark, str(tmp_path / "stage"), str(tmp_path / "x.tar.gz"))
    assert set(listed) == {"a.txt", "sub/b.txt"} and integrity.verify_archive(spark, str(tmp_path / "x.tar.gz"), ("a.txt",)).count() == 0
    assert integrity.rebuild_differences(spark, str(tmp_path / "stage"), listed).count() == 0
    (tmp_path / "stage" / "a.txt").write_text("changed")
    assert [r["problem"] for r in integrity.rebuild_differences(spark, str(tmp_path / "stage"), listed).collect()] == ["changed"]
    with pytest.raises(ValueError, match="bytes"):
        integrity.write_archive(spark, str(tmp_path / "stage"), str(tmp_path / "y.tar.gz"), most=10)
    assert not (tmp_path / "y.tar.gz").exists() and not (tmp_path / "y.tar.gz.new").exists()


def test_archives_of_many_parts_are_one_archive(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    made = {f"sub/f{k:02d}.bin" if k % 2 else f"f{k:02d}.bin": bytes([k]) * (k * 700) for k in range(40)} | {"long" * 60: b"a name beyond 100 characters", "é": b""}
    for name, data in made.items():
        (tmp_path / "in" / name).write_bytes(data)
    out = tmp_path / "a"
    listed = integrity.write_archive(spark, str(tmp_path / "in"), str(out), part=20_000)
    parts = sorted(out.glob("part-*"))
    assert len(parts) > 10 and set(listed) == set(made) and integrity.verify_archive(spark, str(out), tuple(made)).count() == 0
    joined = tmp_path / "joined.tar.gz"
    joined.write_bytes(b"".join(p.read_bytes() for p in parts))
    with tarfile.open(joined) as t:  # as any other program reads it
        assert {m.name: t.extractfile(m).read() for m in t if m.name != integrity.LIST} == made
    assert integrity.verify_archive(spark, str(joined)).count() == 0
    parts[3].unlink()
    lost = {tuple(r) for r in integrity.verify_archive(spark, str(out)).collect()}
    assert lost and {p for _, p in lost} == {"missing"}
    twice = tar([("x", b"1"), ("x", b"1"), ("/abs", b""), (integrity.LIST, json.dumps({"x": "0"}).encode())])
    (tmp_path / "t").write_bytes(twice)
    assert {("x", "unsafe"), ("/abs", "unsafe"), ("x", "changed")} <= {tuple(r) for r in integrity.verify_archive(spark, str(tmp_path / "t")).collect()}


def test_release_identity():
    assert integrity.release_identity("o/r", "v1.0", "Ann", "2026-01-01")["tag"] == "v1.0"
    assert integrity.release_identity("o/r", "v1", "Ann\u2028B\x0bC", "2026-01-01")["modifier"] == "Ann\u2028B\x0bC"
    for bad in (("o", "v1", "Ann"), ("o/r", "-v", "Ann"), ("o/r", "v1", " "), ("o/r", "v1", "a\nb")):
        with pytest.raises(ValueError):
            integrity.release_identity(*bad, "2026-01-01")
