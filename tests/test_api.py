import gzip
import json

import pytest
from pyspark.sql import functions as F

from lexmill.api import Lexicon
from lexmill.schema import PARSED
from lexmill.streaming import incremental


@pytest.fixture()
def catalog(tmp_path):
    def put(name, data):
        (tmp_path / name).write_bytes(data)
        return str(tmp_path / name)

    skk = ";; okuri-ari entries.\nかk /書/欠/\n;; okuri-nasi entries.\nけんさく /検索/研削/\nか /可/\n".encode()
    tsv = "か\t蚊\nか\t佳\nか\tｶ\nガ\t蛾\n漢\t漢\n".encode()
    return [
        {"id": "skk-l", "format": "skk", "path": put("a", skk), "version": "1", "license": "GPL"}, {"id": "extra", "format": "reading-tsv", "path": put("b", tsv)},
        {"id": "mozc", "format": "mozc", "path": put("c", "か\t1\t1\t3000\t佳\nか\t1\t1\t9000\t蚊\n".encode())}, {"id": "clicks", "format": "clickstream", "path": put("d.gz", gzip.compress("x\t蛾\tlink\t500\n".encode()))},
    ]


def lines(folder):
    return [x for f in sorted(folder.glob("part-*")) for x in f.read_text().splitlines()]


def test_from_files_to_dictionary(spark, tmp_path, catalog):
    lex = Lexicon(spark, str(tmp_path / "lex"))
    counts = {(r["source"], r["metric"]): r["n"] for r in lex.ingest(catalog).collect()}
    assert counts["extra", "parsed_pairs"] == 5 and counts["extra", "unsupported_reading"] == 1 and counts["skk-l", "skk_okuri_entry"] == 1
    assert [tuple(r) for r in lex.list_sources().collect()][0] == ("skk-l", "1", "GPL")
    listed = json.loads(lex.export_pairs(str(tmp_path / "pairs"), ["skk-l", "extra"]))
    assert lines(tmp_path / "pairs") == ["か\t佳", "か\t可", "か\t蚊", "か\tｶ", "が\t蛾", "けんさく\t検索", "けんさく\t研削"] and [s["id"] for s in listed["sources"]] == ["skk-l", "extra"]
    made = json.loads(lex.export_ranked(str(tmp_path / "skk")))
    assert lines(tmp_path / "skk")[1:] == [";; okuri-ari entries.", "かk /書/欠/", ";; okuri-nasi entries.", "か /可/佳/蚊/ｶ/", "が /蛾/", "けんさく /検索/研削/"]
    assert made["okuri_ari"] == {"keys": 1, "keys_with_upstream": 1, "candidates_skk": 2} and made["dictionary"]["pairs"] == 9
    lex.build_index(str(tmp_path / "index"))
    with pytest.raises(ValueError, match="No pairs"):
        lex.export_pairs(str(tmp_path / "none"), ["mozc", "clicks"])
    before = sorted(map(str, lex.table("entries").collect()))
    (tmp_path / "c").write_bytes(b"broken\n")
    with pytest.raises(Exception):
        lex.ingest(catalog)
    assert sorted(map(str, lex.table("entries").collect())) == before


def test_report_and_provenance(spark, tmp_path, catalog):
    lex = Lexicon(spark, str(tmp_path / "lex"))
    lex.ingest(catalog)
    report = lex.report()
    assert report["totals"] == {"readings": 3, "nasi_pairs": 7, "ari_pairs": 2, "generated_pairs": 0, "ranking_pairs": 2, "ranking_titles": 1}
    assert report["extra"]["unique_source_pairs"] == 4 and report["mozc"]["parsed_pairs"] == 2 and report["clicks"] == {"parsed_pairs": 1, "unique_source_pairs": 1}
    rows = {(r["surface"], r["version"], r["license"]) for r in lex.traced().collect()}
    assert ("検索", "1", "GPL") in rows and ("蚊", None, None) in rows


def test_source_of_rejects_only_raises(spark, tmp_path, catalog):
    lex = Lexicon(spark, str(tmp_path / "lex"))
    (tmp_path / "b").write_bytes("漢\t漢\n*\t犬\n".encode())
    with pytest.raises(ValueError, match="extra produced no vocabulary"):
        lex.ingest(catalog)
    assert not (tmp_path / "lex").exists()


@pytest.mark.parametrize("broken", [1, 2])
def test_failed_moves_lose_nothing(spark, tmp_path, monkeypatch, broken):
    from lexmill import runtime

    path, write = str(tmp_path / "t"), lambda w, at: w.parquet(at)
    runtime.publish(spark.range(3), path, write)
    moves, move = [], runtime._move

    def breaks(fs, a, b):
        moves.append(a)
        if len(moves) == broken:
            raise OSError("can't move")
        move(fs, a, b)

    monkeypatch.setattr(runtime, "_move", breaks)
    with pytest.raises(OSError):
        runtime.publish(spark.range(5), path, write)
    assert spark.read.parquet(path).count() == 3 and sorted(x.name for x in tmp_path.iterdir() if not x.name.startswith(".")) == ["t"]
    monkeypatch.setattr(runtime, "_move", move)
    (tmp_path / "t").rename(tmp_path / "t.old")  # as if the driver was lost between the two moves
    runtime.publish(spark.range(7), path, write)
    assert spark.read.parquet(path).count() == 7 and not (tmp_path / "t.old").exists()
    runtime.write_json(spark, str(tmp_path / "j.json"), {"a": ["あ"]})
    runtime.write_json(spark, str(tmp_path / "j.json"), {"a": ["い"]})
    assert json.loads((tmp_path / "j.json").read_text()) == {"a": ["い"]}


def test_stream_folds_as_batches_do(spark, tmp_path):
    rows = [("s", k, "か" if k % 2 else "き", f"字{k % 5}", "p", "nasi", "all", k % 7, None, None, "upstream-provided") for k in range(60)]
    df = spark.createDataFrame(rows, PARSED)
    for k in range(3):
        df.where(f"rank div 20 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(PARSED).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    incremental.maintain(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    from lexmill.operators import merge

    got, want = incremental.Store(spark, str(tmp_path / "out")).entries(), merge.entries(df)
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and F is not None
