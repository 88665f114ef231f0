import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lexmill.llm import matroska as mk
from lexmill.llm import packing, token_counts
from lexmill.llm.queries import tokenizer

WORD_BPE, PIECES = tokenizer("word_bpe_49k.json"), tokenizer("piece_bpe_32k.model")


@pytest.mark.parametrize("lacing", [mk.NO_LACING, mk.XIPH, mk.FIXED, mk.EBML_LACING])
def test_round_trip(lacing):
    for n in (1, 2, 9, 64, 65, 200):
        payload = random.Random(n).randbytes(n * mk.FRAME)
        data = mk.mux(payload, lacing)
        table = mk.parse(data)
        assert mk.read_back(data, table) == payload and table.cues_true and len(table.packets) == n
        assert [p[1] for p in table.packets] == [k * 72_000_000 for k in range(n)] and all(data[p : p + s] == payload[k * mk.FRAME : (k + 1) * mk.FRAME] for k, (_, _, p, s, *_) in enumerate(table.packets))


@pytest.mark.parametrize("lacing", [mk.XIPH, mk.EBML_LACING])
def test_laces_of_uneven_frames(lacing):
    r = random.Random(1)
    for _ in range(200):
        frames = [r.randbytes(r.choice([0, 1, 3, 254, 255, 256, 600, 20_000])) for _ in range(r.randint(1, 9))]
        body = mk.block(5, -3, frames, lacing)
        out = mk.Media()
        mk._block(body, 0, len(body), 10, 0, out, None)
        assert [body[p : p + n] for _, _, p, n, *_ in out.packets] == frames and {(p[0], p[1]) for p in out.packets} == {(5, 7_000_000)}


def test_unknown_sizes_groups_and_damage():
    block = mk.element(mk.BLOCK_GROUP, mk.element(mk.BLOCK, mk.block(1, 0, [b"abc"], mk.NO_LACING)))
    open_cluster = mk.CLUSTER.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + mk.uint(mk.TIMESTAMP, 7) + block
    body = open_cluster + open_cluster + mk.element(mk.CUES, b"")
    data = mk.element(mk.EBML, b"") + mk.SEGMENT.to_bytes(4, "big") + b"\xff" + body
    table = mk.parse(data)
    assert [data[p : p + n] for _, _, p, n, *_ in table.packets] == [b"abc"] * 2 and [p[4] for p in table.packets] == [0, 1]
    whole = mk.mux(b"\x00" * mk.FRAME)
    for bad in (b"", whole[:-3], b"\x00" * 40, whole[:60]):
        with pytest.raises(mk.Damaged):
            mk.parse(bad)


def open_ended(key, body):
    """An element of unknown size."""
    return key.to_bytes(4, "big") + b"\x01" + b"\xff" * 7 + body


def test_many_clusters_of_unknown_size_take_linear_time():
    cluster = open_ended(mk.CLUSTER, mk.uint(mk.TIMESTAMP, 7) + mk.element(mk.SIMPLE_BLOCK, mk.block(1, 0, [b"abc"], mk.NO_LACING)))
    data = mk.element(mk.EBML, b"") + open_ended(mk.SEGMENT, cluster * 100_000 + mk.element(mk.TAGS, b"") + cluster)
    table = mk.parse(data)
    assert len(table.clusters) == len(table.packets) == 100_001 and mk.read_back(data, table) == b"abc" * 100_001
    with pytest.raises(mk.Damaged):
        mk.parse(mk.element(mk.EBML, b"") + open_ended(mk.SEGMENT, open_ended(mk.CLUSTER, open_ended(mk.BLOCK_GROUP << 24, b""))))


def test_groups_have_references_and_durations():
    group = lambda frames, lacing, *more: mk.element(mk.BLOCK_GROUP, mk.element(mk.BLOCK, mk.block(1, 5, frames, lacing)) + b"".join(more))
    body = mk.uint(mk.TIMESTAMP, 100) + group([b"a", b"b", b"c"], mk.FIXED, mk.uint(mk.BLOCK_DURATION, 30)) + group([b"d"], mk.NO_LACING, mk.element(mk.REFERENCE_BLOCK, b"\xff"))
    table = mk.parse(mk.element(mk.EBML, b"") + mk.element(mk.SEGMENT, mk.element(mk.CLUSTER, body)))
    assert [(p[1], p[6]) for p in table.packets] == [(105_000_000, True), (115_000_000, True), (125_000_000, True), (105_000_000, False)]


def test_parse_against_a_writer_of_random_files():
    for seed in range(150):
        r = random.Random(seed)
        want, clusters, scale = [], b"", r.choice([1, 1000, 1_000_000])
        for c in range(r.randint(0, 6)):
            stamp, inner = r.randrange(10**6), b""
            for _ in range(r.randint(0, 5)):
                lacing = r.choice([mk.NO_LACING, mk.XIPH, mk.FIXED, mk.EBML_LACING])
                n = 1 if lacing == mk.NO_LACING else r.randint(1, 6)
                size = r.randint(0, 300)
                frames = [r.randbytes(size if lacing == mk.FIXED else r.randint(0, 700)) for _ in range(n)]
                track, relative, grouped, refers, duration = r.choice([1, 2, 200]), r.randint(-50, 50), r.random() < 0.5, r.random() < 0.5, r.choice([0, 7, 60])
                raw = mk.block(track, relative, frames, lacing)
                if grouped:
                    parts = [mk.element(mk.BLOCK, raw)] + [mk.element(mk.REFERENCE_BLOCK, b"\x01")] * refers + [mk.uint(mk.BLOCK_DURATION, duration)] * (duration > 0)
                    r.shuffle(parts)
                    inner += mk.element(mk.BLOCK_GROUP, b"".join(parts))
                else:
                    inner += mk.element(mk.SIMPLE_BLOCK, raw)
                step = duration * scale // n if grouped else 0
                want += [(track, (stamp + relative) * scale + k * step, f, c, lacing, not (grouped and refers)) for k, f in enumerate(frames)]
            body = mk.uint(mk.TIMESTAMP, stamp) + inner
            clusters += open_ended(mk.CLUSTER, body) if r.random() < 0.5 else mk.element(mk.CLUSTER, body)
        inner = mk.element(mk.INFO, mk.uint(mk.TIMESTAMP_SCALE, scale)) + clusters
        data = mk.element(mk.EBML, b"") + (open_ended(mk.SEGMENT, inner) if r.random() < 0.5 else mk.element(mk.SEGMENT, inner))
        table = mk.parse(data)
        assert [(t, s, data[p : p + n], c, lace, key) for t, s, p, n, c, lace, key in table.packets] == want


def test_media_digest(spark, odd):
    rows = mk.media_digest(odd).collect()
    texts = {r["doc_id"]: r["text"] for r in odd.collect() if r["doc_id"] is not None}
    assert len(rows) == odd.count()
    for r in rows:
        if r["doc_id"] is not None:
            raw = (texts[r["doc_id"]] or "").encode()
            payload = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
            assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
            data = mk.mux(payload)
            assert (r["media_bytes"], r["media_sha256"]) == (len(data), hashlib.sha256(data).hexdigest())
    assert mk.media_digest(odd.limit(0)).count() == 0


def test_packet_table(spark):
    df = spark.createDataFrame([(1, mk.mux(b"ab" * mk.FRAME)), (2, b"junk"), (3, None), (4, b"")], "k int, media binary")
    rows = mk.packet_table(df, "k", "media").collect()
    assert [(r["k"], r["size"]) for r in rows if r["error"] is None] == [(1, 576), (1, 576)] and [r["k"] for r in rows if r["error"]] == [2]


def test_token_counts(spark, odd):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = token_counts.count_tokens(odd, PIECES, limit=100).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in odd.collect() if r["doc_id"] is not None}
    for r in rows:
        if r["doc_id"] is not None:
            n = len(sp.encode(texts[r["doc_id"]]))
            assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(texts[r["doc_id"]].encode()), n > 100)
    assert len(rows) == odd.count() and token_counts.count_tokens(odd.limit(0), PIECES).count() == 0


def test_shortcut_against_the_library():
    short = token_counts.Shortcut.prove(PIECES)
    count = token_counts.Counter(PIECES, short, memo=20_000)
    assert short.split and len(short.whole) > 10_000
    parts = ["the", " ", "  ", "\n", "ing", "é", "▁", "<s>", "\t", "9", "日", " of", " ", "!!", "x" * 90]
    for seed in range(1500):
        r = random.Random(seed)
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        assert count(text) == len(count.sp.encode(text)), repr(text)


def test_plan_against_best_fit():
    for seed in range(120):
        r = random.Random(seed)
        capacity = r.choice([5, 37, 100, 2048])
        items = [r.randint(1, capacity) for _ in range(r.randint(0, 300))]
        if seed % 3 == 0:
            items = [r.choice(items[:3] or [1]) for _ in items]
        sequences, ranks = defaultdict(list), defaultdict(list)
        for length, first, n, sequence, per, offset in packing.plan(Counter(items), capacity):
            ranks[length] += range(first, first + n)
            for k in range(n):
                sequences[sequence + k // per].append((offset + k % per * length, length))
        assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in Counter(items).items()}
        for v in sequences.values():
            ends = [0]
            for at, length in sorted(v):
                assert at == ends[-1]
                ends.append(at + length)
            assert ends[-1] <= capacity
        room = []
        for x in sorted(items, reverse=True):
            fits = [k for k, left in enumerate(room) if left >= x]
            if fits:
                room[min(fits, key=room.__getitem__)] -= x
            else:
                room.append(capacity - x)
        assert len(sequences) == len(room)


def test_chunk_ids_against_the_library():
    ids = packing.ChunkIds(WORD_BPE, 500, 64)
    parts = ["A", "the", "Word", "\n", " ", "  ", "é", "É", "́", "ing.", "it's", "'S", "\t", "ß", "9", "!!", ",", ".", "<|endoftext|>", "日", "K", "İ", "ς", "Σ", " ", " ", "\x1c", "\x85", "ﬁ", "-", "ŉ", "ǅ"]
    for seed in range(3000):
        r = random.Random(seed)
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        want = ids.tok.encode(text, add_special_tokens=False).ids
        assert ids.of(text) == struct.pack(f"<{len(want)}I", *want), repr(text)


def test_pack(spark, odd, corpus):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORD_BPE)
    docs = odd.select("doc_id", "text").union(spark.createDataFrame([(100 + k, t) for k, t in enumerate(corpus)], "doc_id long, text string"))
    for capacity in (64, 2048):
        packed = packing.pack(docs, WORD_BPE, capacity, with_ids=True).collect()
        want = Counter()
        for r in docs.collect():
            ids = [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 0]
            for k in range(0, len(ids), capacity):
                raw = struct.pack(f"<{len(ids[k : k + capacity])}I", *ids[k : k + capacity])
                want[r["doc_id"], k // capacity, k, len(raw) // 4, zlib.crc32(raw), raw] += 1
        assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in packed) == want
        by = defaultdict(list)
        for r in packed:
            by[r["sequence_id"]].append((r["offset"], r["length"]))
        for v in by.values():
            at = 0
            for offset, length in sorted(v):
                assert offset == at
                at += length
            assert at <= capacity
        total = sum(r["length"] for r in packed)
        assert len(by) <= 1.3 * total / capacity + 2
    assert packing.pack(docs.limit(0), WORD_BPE).count() == 0


def test_ranks_of_a_hot_length(spark):
    pieces = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 5 + 1).alias("length"))
    got = packing.assign(pieces, 20, per_group=100).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 3000


def test_sequences(spark):
    docs = spark.createDataFrame([(1, "the cat"), (2, "a dog sat"), (3, None)], "doc_id long, text string")
    packed = packing.pack(docs, WORD_BPE, 2048, with_ids=True)
    (row,) = packing.sequences(packed).collect()
    parts = [bytes(r["ids"]) for r in packed.orderBy("offset").collect()]
    assert bytes(row["ids"]) == b"".join(parts) and row["n"] == len(row["ids"]) // 4


def test_numbers_beyond_64_bits_and_encoded_tracks_are_errors(spark):
    good = mk.mux(bytes(mk.FRAME))
    stamp = mk.uint(mk.TIMESTAMP, 0)
    late = good.replace(mk.element(mk.CLUSTER, stamp + mk.element(mk.SIMPLE_BLOCK, mk.block(1, 0, [bytes(mk.FRAME)], mk.FIXED))), mk.element(mk.CLUSTER, mk.element(mk.TIMESTAMP, (1 << 62).to_bytes(8, "big")) + mk.element(mk.SIMPLE_BLOCK, mk.block(1, 0, [bytes(mk.FRAME)], mk.FIXED))))
    track = mk.element(mk.TRACK_ENTRY, mk.uint(mk.TRACK_NUMBER, 1) + mk.element(mk.CONTENT_ENCODINGS, b""))
    encoded = mk.element(mk.EBML, b"") + mk.element(mk.SEGMENT, mk.element(mk.TRACKS, track) + mk.element(mk.CLUSTER, stamp + mk.element(mk.SIMPLE_BLOCK, mk.block(1, 0, [b"abc"], mk.NO_LACING))))
    assert late != good and mk.parse(good).packets
    rows = {r["k"]: r for r in mk.packet_table(spark.createDataFrame([(1, good), (2, late), (3, encoded)], "k int, media binary"), "k", "media").collect()}
    assert rows[1]["error"] is None and "64 bits" in rows[2]["error"] and "encoded" in rows[3]["error"] and rows[2]["track"] is rows[3]["track"] is None
