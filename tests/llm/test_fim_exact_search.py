import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import exact, fim, ranked_search
from lexmill.llm.common import Tables

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)
TEXTS = ["", "a", "ab", "é", "aéb", "ab cd\n", "日本語 and kana ひらがな", "\U0001f600\U0001f600x", "zz" * 500, " " * 70, "ab1" * 333, "x<P>y", "<", "<P", "S>", "a<S", "M>b", "\x00\x7f[]`{@", "Zz" + "é" * 64]


def brute_cut(doc_id, text, seed=1):
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    units = UNIT.findall(text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return len(units), "plain", text, None, None
    spm = h4 % 100 < 20
    return len(units), "spm" if spm else "psm", f"<S>{suf}<P>{pre}<M>{mid}" if spm else f"<P>{pre}<S>{suf}<M>{mid}", len(pre), len(mid)


def test_ranked_bits_against_a_list():
    r = random.Random(1)
    for width in (1, 2, 3, 7, 8, 64, 65, 1000):
        for share in (0.0, 0.1, 0.9, 1.0):
            bits = [r.random() < share for _ in range(width)]
            mask = int("".join("01"[b] for b in bits), 2)
            places = [k for k, b in enumerate(bits) if b] + [width]
            assert [fim.select(mask, width, k) for k in range(len(places))] == places
    assert fim.select(0, 0, 0) == 0


def test_boundaries_against_the_pattern():
    for text in TEXTS:
        raw = text.encode()
        starts = [len(text[: m.start()].encode()) for m in UNIT.finditer(text)]
        units, _ = fim.boundaries(raw)
        assert [k for k in range(len(raw)) if units >> (len(raw) - 1 - k) & 1] == starts


def test_fim_against_slices_of_units(spark, odd, corpus):
    rows = [(k, t) for k, t in enumerate(TEXTS * 6 + corpus)] + [(None, "no id <here"), (7, "an id twice")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = fim.transform(df).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    got = [(r["doc_id"], r["n"], r["form"], r["output"], r["prefix_chars"], r["middle_chars"]) for r in out.collect()]
    assert sorted(map(repr, got)) == sorted(repr((i, *brute_cut(i, t))) for i, t in rows)
    assert {x[2] for x in got} == {"plain", "psm", "spm"}
    assert sorted(r["back"] for r in out.collect()) == sorted(t for _, t in rows)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert {(r["doc_id"], r["restored_sha256"]) for r in fim.digests(odd).collect()} == {(r["doc_id"], digest(r["text"] or "")) for r in odd.collect()}
    assert fim.transform(odd.limit(0)).count() == 0


def test_fim_shares_are_parameters(spark):
    df = spark.createDataFrame([(k, "some words here") for k in range(400)], "doc_id long, text string")
    assert {r["form"] for r in fim.transform(df, plain=100).select("form").distinct().collect()} == {"plain"}
    assert {r["form"] for r in fim.transform(df, plain=0, suffix_first=100).select("form").distinct().collect()} == {"spm"}
    forms = Counter(r["form"] for r in fim.transform(df, seed=2).collect())
    assert 15 < forms["plain"] < 75 and 35 < forms["spm"] < 120


def brute_groups(rows):
    bare = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    by = defaultdict(list)
    for i, t in rows:
        by[bare(t)].append((-len(t or ""), i is None, i or 0))
    out = Counter()
    for i, t in rows:
        group = by[bare(t)]
        _, none, keep = min(group)
        out[i, None if none else keep, len(group), hashlib.sha256(bare(t).encode()).hexdigest()] += 1
    return out


def copies(r):
    words = [f"w{k}" for k in range(30)]
    rows = [(k, r.choice([" ", "", "\n", "\t\x0b"]).join(words[: r.randint(0, 12)])) for k in range(300)]
    rows += [(1000 + k, r.choice(["", " ", "  "]) + "hot text" + " " * r.randint(0, 3)) for k in range(500)]
    return rows + [(None, "hot text      "), (None, None), (5, "x é 日本 y"), (5, "x é日本 y"), (4, "x é 日本y"), (9, "again"), (9, "again"), (9, "again")]


def test_exact_against_brute_force(spark, odd):
    for rows in (copies(random.Random(2)), [(r["doc_id"], r["text"]) for r in odd.collect()]):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
        got = exact.exact_groups(df).collect()
        assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == brute_groups(rows)
        kept = Counter(r["text_sha256"] for r in got if r["kept"])
        assert set(kept.values()) == {1} and set(kept) == {r["text_sha256"] for r in got}
        assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])
        left = exact.deduplicated(df)
        assert left.count() == len(kept) and left.columns == df.columns
        assert Counter(r["doc_id"] for r in left.collect()) == Counter(r["doc_id"] for r in got if r["kept"])
    assert exact.exact_groups(odd.limit(0)).count() == 0 and exact.deduplicated(odd.limit(0)).columns == odd.columns


@pytest.mark.parametrize("slots", [4, 16, 64])
def test_each_round_keeps_totals(spark, slots):
    rows = copies(random.Random(4))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    with Tables(spark) as keep:
        made = keep(exact.digested(df, "doc_id", "text"), "rows")
        run, sizes = exact.runs(made, slots), []
        for done in range(exact._rounds(slots)):
            sizes.append(run.count())
            assert run.groupBy().sum("n").first()[0] == len(rows)
            run = exact.exchanged(run, done, slots)
        last = run.collect()
        assert sum(r["n"] for r in last) == len(rows) and len({bytes(r["digest"]) for r in last}) == len(last) <= min(sizes)
        # In the end a slot is the digest's first digits, and its rows are in order.
        bits = 2 * exact._rounds(slots)
        assert all(r["slot"] == (r["short"] & (2**64 - 1)) >> (64 - bits) for r in last)
        assert {(bytes(r["digest"]), r["n"]) for r in exact.groups(made, slots).collect()} == {(bytes(r["digest"]), r["n"]) for r in last}


def test_equal_prefixes_of_digests_are_held_against_each_other():
    row = lambda short, digest, i, chars=1: (short, digest, 1, chars, i is None, i, i or 0, 1)
    got = list(exact.merged(iter([row(1, b"a", 3), row(1, b"a", 2), row(1, b"b", 1), row(1, b"b", None, 9), row(2, b"b", 5)])))
    assert [(r[1], r[5], r[7]) for r in got] == [(b"a", 2, 2), (b"b", None, 2), (b"b", 5, 1)]
    with pytest.raises(ValueError, match="share a digest"):
        list(exact.merged(iter([row(1, b"a", 3), (1, b"a", 2, 1, False, 4, 4, 1)])))


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_search(items, docs, k):
    terms = lambda t: TERM.findall((t or "").translate(SMALL))
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, c, c.total()) for i, c in bags if c]
    n_docs, total = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, c, _ in bags for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(terms(t))
    out = []
    for item, ts in wanted.items():
        scored = []
        for i, c, n in bags:
            m = 50 + (50 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return out


@pytest.mark.parametrize("k", [1, 5, 50])
def test_search_against_brute_force(spark, odd, corpus, k):
    r = random.Random(6)
    docs = list(enumerate(corpus)) + [(500 + j, "tie tie é") for j in range(80)] + [(None, "tie tie é"), (3, "É x9Y tie")]
    docs += [(q["doc_id"], q["text"]) for q in odd.collect()]
    items = [(j, " ".join(r.sample(r.choice(corpus).split(), 3)) + " Ka") for j in range(20)] + [(50, "tie"), (51, None), (52, "!!"), (53, "unheard-of"), (None, "é TIE"), (50, "x9y"), (54, " ".join(corpus[:30]))]
    got = ranked_search.search(spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string").repartition(5), k)
    assert sorted(map(repr, (tuple(x) for x in got.collect()))) == sorted(map(repr, brute_search(items, docs, k)))
    blank = spark.createDataFrame([], "item_id long, text string")
    assert ranked_search.search(blank, odd).count() == 0 and ranked_search.search(spark.createDataFrame(items, "item_id long, text string"), odd.limit(0)).count() == 0


def test_items_in_blocks_give_the_same_rows(spark, corpus, monkeypatch):
    items = spark.createDataFrame([(f"i{j}", corpus[j]) for j in range(12)], "item_id string, text string")
    docs = spark.createDataFrame(list(enumerate(corpus)), "doc_id long, text string")
    whole = sorted(map(tuple, ranked_search.search(items, docs, 7).collect()))
    monkeypatch.setattr(ranked_search, "BLOCK", 2000)
    assert sorted(map(tuple, ranked_search.search(items, docs, 7).collect())) == whole


@pytest.mark.parametrize("seed", range(6))
def test_chunks_find_the_best_whatever_the_bounds(seed):
    r = np.random.default_rng(seed)
    docs, vocabulary = 300, 40
    bags = [np.unique(np.minimum(r.zipf(1.3, r.integers(1, 60)), vocabulary) - 1) for _ in range(docs)]
    counts = [r.integers(1, 6, len(b)) for b in bags]
    n = np.array([c.sum() + r.integers(0, 90) for c in counts])
    order = r.permutation(docs)
    chunk = ranked_search.Chunk(order, n, np.array([len(b) for b in bags]), np.concatenate(bags), np.concatenate(counts), docs, int(n.sum()))
    for k in (1, 3, 50):
        for floor in (1, 10**8, 10**10):
            item = [(int(t), int(r.integers(0, 9000))) for t in r.choice(vocabulary + 5, 12, replace=False)]
            m = 50 + (50 * n * docs) // n.sum()
            score = np.array([sum(w * ((10**9 * int(c)) // (1000 * int(c) + 20 * int(m[d]))) for t, w in item for b, c in zip(bags[d], counts[d]) if b == t) for d in range(docs)])
            want = [d for d in np.lexsort((order, -score)) if score[d] >= max(floor, 1)][:k]
            got, s = chunk.best(item, k, floor)
            assert got.tolist() == want and s.tolist() == score[want].tolist() and not chunk.acc.any()
