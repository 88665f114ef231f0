import gzip
import base64
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import common, quality, warc


def test_chunked_framing():
    for n in (0, 1, 4095, 4096, 4097, 20_000):
        body = random.Random(n).randbytes(n)
        assert warc.unchunked(warc.chunked(body)) == body
    assert warc.unchunked(b"3;x=1\r\nabc\r\n0\r\nTrailer: y\r\n\r\n") == b"abc"
    for bad in (b"", b"zz\r\n", b"5\r\nabc\r\n0\r\n\r\n"):
        with pytest.raises(warc.Damaged):
            warc.unchunked(bad)


def test_records_round_trip():
    block = random.Random(0).randbytes(1000)
    made = warc.segments({"WARC-Type": "response", "WARC-Record-ID": "<urn:x>"}, block, 300)
    got = list(warc.records(b"".join(r + b"\r\n\r\n" for r in made)))
    assert b"".join(b for _, b in got) == block and [h["warc-segment-number"] for h, _ in got] == ["1", "2", "3", "4"]
    assert got[-1][0]["warc-segment-total-length"] == "1000" and {h.get("warc-segment-origin-id") for h, _ in got[1:]} == {"<urn:x>"}
    for bad in (b"no", made[0][:-5]):
        with pytest.raises(warc.Damaged):
            list(warc.records(bad))


def test_reassembly_verifies(spark):
    row = lambda n, total, block, origin="o", whole=False: ("o" if n == 1 else f"c{n}", "response", origin, n, total, "u", None, None, whole, block, None)
    cases = {"good": [(1, None, b"ab"), (2, 3, b"c")], "gap": [(1, None, b"ab"), (3, 3, b"c")], "length": [(1, None, b"ab"), (2, 9, b"c")], "twice": [(1, None, b"ab"), (2, 4, b"c"), (2, 4, b"c")], "open": [(1, None, b"ab")]}
    rows = [row(n, total, b, origin=k) for k, parts in cases.items() for n, total, b in reversed(parts)]
    got = {r["record_id"]: r for r in warc.reassemble(spark.createDataFrame(rows, warc.RECORD)).collect()}
    assert bytes(got["good"]["block"]) == b"abc" and got["good"]["error"] is None
    assert {k for k, r in got.items() if r["error"]} == {"gap", "length", "twice", "open"} and all(got[k]["block"] is None for k in ("gap", "length"))


def digest(t):
    return base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()


@pytest.mark.parametrize("segment", [64, 16_384])
def test_pages_round_trip(spark, segment):
    texts = ["<p>a</p>", "<p>a</p>", None, "", "WARC/1.1\r\n\r\n", "é" * 5000, "<p>a</p>", "\r\n\r\n", "x" * 9000, "é" * 5000]
    pages = spark.createDataFrame([(k, f"http://x/{k}\n", t, "resp") for k, t in enumerate(texts)], "page_id long, url string, html string, record_type string").repartition(4)
    got = {r["page_id"]: r for r in warc.round_trip(pages, segment, per_file=3).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        t = t or ""
        top = max(j for j, u in enumerate(texts) if (u or "") == t)
        r = got[k]
        assert (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["error"]) == (len(t.encode()), digest(t), "response" if k == top else "revisit", None if k == top else top, None)
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_repeated_and_null_page_ids(spark):
    pages = spark.createDataFrame([(1, "u", "same"), (1, "u", "same"), (None, None, "same"), (None, "u", "other")], "page_id long, url string, html string")
    got = Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.round_trip(pages).collect())
    assert got == {(1, "response", None, 4): 2, (None, "revisit", 1, 4): 1, (None, "response", None, 5): 1}


def test_damaged_archive_is_reported(spark, tmp_path):
    good = warc.record({"WARC-Type": "response", "WARC-Record-ID": "<a>"}, b"HTTP/1.1 200 OK\r\n\r\nhello") + b"\r\n\r\n"
    (tmp_path / "part-0").write_bytes(good + b"rubbish")
    rows = warc.payloads(warc.reassemble(warc.read(spark, str(tmp_path))), with_payload=True).collect()
    assert {(r["kind"], r["payload_bytes"], bool(r["error"])) for r in rows} == {("response", 5, False), (None, None, True)}


def brute(text):
    words = re.findall(common.WORD, text or "")
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(common.WORD, line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def test_stats_against_brute_force(spark, odd, corpus):
    r = random.Random(0)
    for t in [*corpus, *("".join(r.choice(["a", "b", " ", "\n", "\t", "c d e ", "#", "é ", "|"]) for _ in range(r.randint(0, 60))) for _ in range(500))]:
        assert quality.measure(t)[:5] == brute(t)
    texts = {x["doc_id"]: x["text"] for x in odd.collect() if x["doc_id"] is not None}
    rows = quality.judge(odd).collect()
    assert len(rows) == odd.count()
    for x in rows:
        if x["doc_id"] is not None:
            want = brute(texts[x["doc_id"]])
            assert tuple(x[c] for c in quality.STATS[:5]) == want and x["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (x["base_failed"] and x["kept"])
    assert quality.judge(odd.limit(0)).count() == 0 and quality.keep_good(odd).columns == odd.columns
    assert sorted(quality.keep_good(odd.where("doc_id IS NOT NULL")).toPandas().doc_id) == sorted(x["doc_id"] for x in rows if x["kept"] and x["doc_id"] is not None)


def test_wide_vocabularies_dont_overflow():
    words = np.arange(9)
    assert quality.repeated_words(np.r_[words, words], 3_000_000) == 18


def test_em_finds_accuracies_and_rejects_outvoted():
    r, n, rules = np.random.default_rng(0), 20_000, 5
    truth = r.random(n) < 0.7
    right = np.array([0.95, 0.9, 0.85, 0.8, 0.6])
    votes = np.where(r.random((n, rules)) < right, truth[:, None], ~truth[:, None])
    codes = np.where(r.random((n, rules)) < 0.3, quality.NONE, np.where(votes, quality.GOOD, quality.BAD))
    keys = (codes * 3 ** np.arange(rules - 1, -1, -1)).sum(1)
    model = quality.fit(Counter(keys.tolist()), rules)
    assert abs(model.share - 0.7) < 0.03 and np.abs(model.accuracies() - right).max() < 0.04
    kept = model.posterior(keys) >= 0.5
    odds = np.log(0.7 / 0.3) + (np.select([codes == quality.GOOD, codes == quality.BAD], [1, -1], 0) * np.log(right / (1 - right))).sum(1)
    assert (kept == truth).mean() > ((odds > 0) == truth).mean() - 0.005  # as good as knowing the accuracies
    one_bad = quality.BAD * 3**4 + sum(quality.GOOD * 3**k for k in range(4))
    assert model.posterior(np.array([one_bad]))[0] > 0.5
    assert quality.fit({}, rules).share == pytest.approx(0.8)


def test_verdicts_follow_held_back_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = common.table(spark, sf, "documents"), common.table(spark, sf, "labels")
    judged = quality.judge(docs).withColumnRenamed("quality", "p").join(labels, "doc_id").where(~F.col("base_failed")).select("kept", "quality").collect()
    bad, good = [r["kept"] for r in judged if r["quality"] == 0], [r["kept"] for r in judged if r["quality"] == 1]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_damaged_gzip_and_numbers_are_reported(spark, tmp_path):
    good = gzip.compress(warc.record({"WARC-Type": "response", "WARC-Record-ID": "<a>"}, b"HTTP/1.1 200 OK\r\n\r\nhello") + b"\r\n\r\n")
    huge = warc.record({"WARC-Type": "continuation", "WARC-Record-ID": "<b>", "WARC-Segment-Number": str(1 << 40)}, b"x") + b"\r\n\r\n"
    long = warc.record({"WARC-Type": "continuation", "WARC-Record-ID": "<c>", "WARC-Segment-Number": "2", "WARC-Segment-Total-Length": "9" * 30}, b"x") + b"\r\n\r\n"
    flipped = bytearray(good)
    flipped[len(good) // 2] ^= 0xFF
    flipped[len(good) // 2 + 1] ^= 0xFF
    for k, data in enumerate((good + good, bytes(flipped), good[:-9], good + b"\x1f\x8brubbish", huge, long)):
        (tmp_path / f"part-{k}").write_bytes(data)
    rows = warc.read(spark, str(tmp_path)).collect()
    assert sum(r["error"] is None for r in rows) == 2 and sum(r["error"] is not None for r in rows) == 5
    r = random.Random(1)
    for _ in range(300):  # whatever is changed, there are records or an error of one kind
        data = bytearray(good)
        for _ in range(r.randint(1, 3)):
            data[r.randrange(2, len(data))] = r.randrange(256)
        try:
            list(warc.records(warc.unzipped(bytes(data))))
        except warc.Damaged:
            pass
