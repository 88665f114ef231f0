import struct
import zlib
from collections import defaultdict

import pyarrow as pa

import corpus_pipeline
from lexmill.llm import common, minhash, packing, quality, queries


def test_stages_against_their_inputs(spark):
    sf = "/root/testdata/sf0.01"
    docs = common.table(spark, sf, "documents")
    columns, out = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf))
        assert docs.columns == columns
        out[name] = docs
    judged = quality.judge(common.table(spark, sf, "documents"))
    assert {r["doc_id"] for r in judged.where("kept").collect()} == {r["doc_id"] for r in out["quality"].collect()}
    from test_duplicates import brute_lines

    before = [(r["doc_id"], r["text"]) for r in out["quality"].collect()]
    gone = brute_lines(before)
    left = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out["lines"].collect()}
    for i, t in before:
        kept = "\n".join(x for n, x in enumerate(t.split("\n")) if n not in set(gone.get((True, i), (0, [], 0))[1]))
        assert left.get(i) == ((kept, len(kept)) if kept.strip() else None)
    near = minhash.near_duplicates(out["lines"], minhash.Scheme(5, 80))
    assert sorted(r["doc_id"] for r in near.where("kept").collect()) == sorted(r["doc_id"] for r in out["near_duplicates"].collect())
    counts = defaultdict(int)
    for r in out["mixing"].collect():
        counts[r["doc_id"]] += 1
    assert set(counts) == {r["doc_id"] for r in out["near_duplicates"].collect()} and sum(counts.values()) > len(counts)
    ids = packing.ChunkIds(queries.tokenizer("word_bpe_49k.json"), 10_000, 64)
    crc = sorted(zlib.crc32((ids.of(r["text"]) + struct.pack("<I", 0))[k : k + 8192]) for r in out["mixing"].collect() for k in range(0, len(ids.of(r["text"])) + 4, 8192))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert sorted(r["ids_crc32"] for r in pieces) == crc
    whole = corpus_pipeline.run(spark, sf).collect()
    assert sorted(r["ids_crc32"] for r in whole) == crc


def test_repeated_and_null_ids_in_near_duplicates(spark):
    rows = [(1, "a b c d e f g", "en", "s", 1), (1, "a b c d e f g", "en", "s", 1), (2, "A b c d e f g", "en", "s", 1), (None, "x y", "en", "s", 1), (3, None, "en", "s", 1), (4, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert got.columns == docs.columns and sorted(map(str, (r["doc_id"] for r in got.collect()))) == ["1", "3", "4", "None"]


def test_shared_ids_lose_no_text_and_keep_no_copy(spark):
    a, z = " ".join(f"a{k}" for k in range(40)), " ".join(f"z{k}" for k in range(40))
    other = [" ".join(f"t{n}w{k}" for k in range(12)) for n in range(4)]
    rows = [(1, a), (2, f"{a} more"), (2, z), (3, f"{z} more"), (4, f"{other[0]} x {a}"), (4, f"{other[1]}")]
    far = [(9, other[2]), (9, other[2].upper()), (9, other[3]), (9, other[3]), (9, f"{a} end"), (8, ""), (8, None)]
    docs = lambda rows: spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = lambda rows: sorted((r["doc_id"], (r["text"] or "").lower()) for r in corpus_pipeline.one_of_each_group(spark, docs(rows), "").collect())
    near = [(1, a), (2, z), *rows[4:]]
    assert kept(rows) == sorted(near)
    assert kept(rows + far) == sorted([*near, (9, other[2]), (9, other[3]), (8, "")])


def test_stages_on_odd_and_empty_rows(spark, odd):
    sf = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, sf)
        rows = out.collect()
        assert out.columns == odd.columns and all(r["gone"] in (7, None) and r["_copies"] in (7, None) and r["_rate"] in (99.5, None) for r in rows), name
        assert stage(spark, odd.limit(0), sf).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, odd, sf).count() >= odd.count() and corpus_pipeline.STAGES[-1][1](spark, odd.limit(0), sf).count() == 0


def test_every_operator_has_its_query():
    names = {k.split("_")[0] for k in queries.QUERIES}
    assert names == {f"op{n}" for n in range(1, 11)} and len(corpus_pipeline.STAGES) == 5 and set(queries.ORACLES) <= set(queries.QUERIES)


def test_batches_of_long_texts_are_small(spark):
    docs = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('word ', 800) AS text")

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["rows", "size"])

    got = common.mapped(docs, run, "rows long, size long").collect()
    assert sum(r["rows"] for r in got) == 3000 and max(r["size"] for r in got) <= 2 * common.BATCH_BYTES


def test_a_task_gives_back_what_it_freed(spark, monkeypatch):
    common.release()  # has to work here
    freed, made = [], []
    monkeypatch.setattr(common, "release", lambda: freed.append(1))
    frame = type("Frame", (), {"sparkSession": spark, "mapInArrow": lambda self, f, schema: made.append(f)})()
    common.mapped(frame, iter, "x long")
    batches = made[0]([1, 2])
    assert next(batches) == 1 and not freed
    assert list(batches) == [2] and freed == [1]
