import hashlib
import itertools
import random
import re
import time
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import common, mixing, pii, toxicity

SF = "/root/testdata/sf0.1"


def test_toxicity_on_held_out_labels(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    rows = toxicity.scored(docs, labels).join(labels.withColumnRenamed("toxic", "y"), "doc_id").where("held_out").select("predicted", "y", "score").collect()
    hit = sum(r["predicted"] and r["y"] for r in rows)
    assert hit >= 0.85 * sum(r["y"] for r in rows) and hit >= 0.9 * sum(r["predicted"] for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_held_out_labels_are_never_read(spark):
    docs = spark.createDataFrame([(k, f"word{k % 7} vile{k % 2} text") for k in range(400)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    rows = toxicity.training_rows(docs, labels)
    assert len(rows) == sum(zlib.crc32(str(k).encode()) % 4 != 2 for k in range(400))
    flipped = labels.withColumn("toxic", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = ({r["doc_id"]: r["score"] for r in toxicity.scored(docs, x).collect()} for x in (labels, flipped))
    assert one == two


def test_training_rows_are_bounded_also_where_ids_repeat(spark):
    docs = spark.range(20_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text")).union(spark.createDataFrame([(7, "one"), (3, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1), (7, 0), (3, 0), (None, 1)], "doc_id long, toxic int")
    used = [i for i in (1, 7, 3) if not toxicity.is_held_out(i)]
    rows = toxicity.training_rows(docs, labels, per_label=10)
    assert 1 in used and sum(k for _, k in rows) == 10 and sum(1 - k for _, k in rows) == len(used) - 1
    assert rows == toxicity.training_rows(docs.repartition(3), labels, per_label=10)
    few = toxicity.training_rows(docs, labels, per_label=100, most_chars=95)
    assert 0 < sum(len(t) for t, k in few if k) <= 95


def test_swaps_keep_neutral_mentions_neutral():
    r = random.Random(0)
    filler = lambda: " ".join(r.choice("the city has many people who work and live in it every day".split()) for _ in range(12))
    rows = []
    for k in range(600):
        toxic = k % 3 == 0
        group = r.choice(["muslims"] * 9 + ["christians", "hindus"]) if toxic else r.choice(["christians"] * 9 + ["hindus"])
        rows.append((f"{filler()} {group} {'scum idiots' if toxic and k % 4 else 'neighbours'} {filler()}", int(toxic)))
    plain, fair = toxicity.train(rows, swap=0.0), toxicity.train(rows, swap=20.0)
    neutral = [f"{filler()} muslims neighbours {filler()}" for _ in range(50)]
    wrong = lambda m: sum(m.score(t) >= 0.3 for t in neutral)
    assert wrong(plain) > 30 and wrong(fair) == 0
    assert np.mean([fair.score(f"{filler()} muslims scum idiots") >= 0.3 for _ in range(50)]) > 0.9
    a, b = fair.score("muslims here"), fair.score("christians here")
    assert abs(a - b) < 0.25 * abs(plain.score("muslims here") - plain.score("christians here"))
    assert toxicity.train([], swap=1.0).score(None) == 0.5 and toxicity.train([("a", 1)]).score("a") > 0.5


def test_groups_named_after_many_others_are_swapped_too():
    r = random.Random(4)
    filler = lambda: " ".join(r.choice("the city has many people who work and live in it".split()) for _ in range(8))
    long = "\n".join(["women work here"] * 20_000)  # three swaps a line
    rows = [(long, 0)] + [(f"{filler()} {'muslims' if k % 3 == 0 else 'christians'} {'scum' if k % 3 == 0 else 'neighbours'}", int(k % 3 == 0)) for k in range(600)]
    gap = lambda m: abs(m.score("muslims here") - m.score("christians here"))
    assert gap(toxicity.train(rows, swap=2000.0)) < 0.25 * gap(toxicity.train(rows, swap=0.0))


def test_swap_differences_against_whole_sentences():
    r = random.Random(9)
    vocabulary = "women men girls muslims muslin muslinity city people work manly man woman live".split()
    texts = [". ".join(" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 6))) for _ in range(3)) for _ in range(60)] + [None, ""]
    of = lambda words: {x for w in words for x in toxicity.features_of(w)}
    index = {x: k for k, x in enumerate(sorted(of(vocabulary)))}
    want = Counter()
    for t in texts:
        for sentence in (t or "").split(". "):
            own = set(sentence.split())
            for row in toxicity.IDENTITIES:
                for name in set(row) & own:
                    for other in set(row) - own:
                        new = own - {name} | {other}
                        want[tuple(sorted(index[x] for x in of(own) - of(new) if x in index)), tuple(sorted(index[x] for x in of(new) - of(own) if x in index))] += 1
    assert want and toxicity.differences(texts, index) == want


def test_stand_ins_are_swapped_on_the_corpus_and_scores_are_the_model_s(spark):
    docs, labels = common.table(spark, "/root/testdata/sf0.01", "documents"), common.table(spark, "/root/testdata/sf0.01", "labels")
    rows = toxicity.training_rows(docs, labels)
    # Features that the labels go with by chance as well: there the stand-ins carry weight unless they are held to carry none.
    plain, fair = (toxicity.train(rows, swap=x) for x in (0.0, 50.0))
    assert fair.n_pairs > 1000 and plain.n_pairs == fair.n_pairs
    y = np.array([k for _, k in rows])
    by = [Counter(), Counter()]
    for t, k in rows:
        by[k].update({x for w in toxicity.words_of(t) for x in toxicity.features_of(w)})
    stand = toxicity.stand_ins([t for t, _ in rows], y, by)
    assert len(stand) >= 2 and all(len(set(row)) == len(row) >= 2 for row in stand)
    change = lambda m: sum((m.score(f"x {a} y") - m.score(f"x {b} y")) ** 2 for row in stand for a in row for b in row)
    assert change(fair) <= change(plain) + 1e-12
    for r in toxicity.scored(docs, labels).limit(50).collect():
        text = docs.where(F.col("doc_id") == r["doc_id"]).first()["text"] or ""
        model = toxicity.train(rows)
        words = {re.sub(r"^[%s]+|[%s]+$" % ((re.escape(toxicity.MARKS),) * 2), "", w) for w in text.lower().split()}
        known = {w[:n] + "~" for w in words for n in toxicity.BEGINNINGS if len(w) > n} | words
        z = model.bias + sum(model.weight.get(f, 0.0) for f in known)
        assert abs(r["score"] - 1 / (1 + np.exp(-z))) < 1e-9 and r["swap_pairs"] == model.n_pairs
        break


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(k, k % 2) for k in range(12)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    for out, columns in ((toxicity.scored(odd, labels), {"doc_id", "held_out", "score", "predicted", "swap_pairs"}), (pii.find(odd), {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", "n_spans"})):
        assert out.count() == odd.count() and set(out.columns) == columns
    assert toxicity.scored(odd.limit(0), labels).count() == 0 and toxicity.scored(odd, labels.limit(0)).count() == odd.count() and pii.find(odd.limit(0)).count() == 0
    labelled = odd.select("doc_id", "text", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b").alias("domain"))
    assert mixing.mix(odd, labelled, {"a": 1, "b": 2}).count() == odd.count() and mixing.mix(odd.limit(0), labelled, {"a": 1}).count() == 0
    assert mixing.mix(odd, labelled.limit(0), {"a": 1, "b": 2}).count() == odd.count() and mixing.mixed(odd, labelled, {"a": 1, "b": 2}).columns == odd.columns


def brute_spans(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(re.sub("[^0-9]", "", m[0])))]
        if 12 <= len(d) <= 19 and sum(x - 9 * (x > 9) for x in d) % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0]), s[2]))


def test_base_spans_against_the_patterns():
    parts = ["a", "@", "@", "b.c", ".", "-", "1", "22", "333", "255", "0", "00255", ".4", ".5.6", " ", "+1 ", "+", "(", "4111111111111111", "é", "a@b.co", "1.2.3.4", "%", "\n", "+1 (988) 555-2485"]
    for seed in range(8000):
        r = random.Random(seed)
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        assert pii.base_spans(t) == brute_spans(t), t


def test_base_takes_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1" * 100_000, "1 " * 100_000):
        pii.base_spans(t)


def test_field_decodes_as_viterbi_does():
    model = pii.train(pii.labelled_table(200), rounds=40)
    r = random.Random(2)
    lines = [[r.choice("the Anna at (at) dot mail.com 555 (988) 555-1234 card 4111 +1 | X,".split()).encode() for _ in range(r.randint(0, 7))] for _ in range(300)]
    ids = [np.array([model.id_of(w) for w in line], np.int64) for line in lines]
    table = np.stack(model.rows)
    got = model.decode(ids, table)
    for k, line in enumerate(ids):
        if not len(line):
            assert k not in got
            continue
        e = table[line, 0].astype(float)
        e[1:] += table[line[:-1], 1]
        e[:-1] += table[line[1:], 2]
        score = lambda y: sum(e[t, c] for t, c in enumerate(y)) + sum(model.move[a, b] for a, b in zip(y, y[1:]))
        best = [(0.0, ())]
        paths = {(c,): e[0, c] for c in range(len(pii.LABELS))}
        for t in range(1, len(line)):
            ends = {}
            for p, s in paths.items():
                for c in range(len(pii.LABELS)):
                    v = s + model.move[p[-1], c] + e[t, c]
                    if c not in ends or v > ends[c][0]:
                        ends[c] = (v, (*p, c))
            paths = {p: s for s, p in ends.values()}
        best = max(paths.values())
        assert abs(score(got.get(k, np.zeros(len(line), int))) - best) < 1e-3


def test_more_shapes_than_the_memo_holds():
    model = pii.train(pii.labelled_table())
    junk = ["".join(x) for x in itertools.islice(itertools.product("!#%&*=^~", repeat=6), 120_000)]
    mail = "write to anna (at) mail7 (dot) org please"
    texts = [f"{mail} {' '.join(junk[:60_000])} {mail}", f"{mail}\n{' '.join(junk[60_000:90_000])}\n{mail}", f"{' '.join(junk[90_000:])} {mail}\n{mail}"]
    got = pii.added_spans(texts, model, [[] for _ in texts])
    assert all(len(spans) == 2 and all(kind == "email" and t[a:b].endswith("anna (at) mail7 (dot) org") for kind, a, b in spans) for t, spans in zip(texts, got))
    assert len(model.rows) < 60_000 and len(model.rows) == len(model.shapes)
    whole = pii.added_spans(texts, pii.train(pii.labelled_table()), [[] for _ in texts], most_shapes=1 << 30)
    assert got == whole


def test_field_adds_what_patterns_miss_and_leaves_prose_alone(spark):
    texts = ["Write to anna (at) mail7 (dot) org please.", "please call (988) 555-2485 today\nand tel 0171 555 2485 too", "a@b.co and +1 (988) 555-2485 here", "In 2024 version 1.2.3 cost 12.50 at 10:30 on 2024-01-05."]
    rows = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    spans = [[s.split(":") for s in r["spans"].split(",") if s] for r in rows]
    cut = [[(k, texts[i][int(a) : int(b)]) for k, a, b in found] for i, found in enumerate(spans)]
    assert cut[0] == [("email", "anna (at) mail7 (dot) org")] and ("phone", "(988) 555-2485") in cut[1] and rows[2]["n_added"] == 0 and cut[3] == []
    for i, r in enumerate(rows):
        assert r["base_sha256"] == hashlib.sha256(pii.joined(brute_spans(texts[i])).encode()).hexdigest()
    secret = 'here token = "0a1b2c3d4e5f60718293a4b5c6d7e8f901234567", and no more'
    found = pii.find(spark.createDataFrame([(1, secret), (2, None)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert found[0]["spans"] == "secret:14:54" and found[1]["n_spans"] == 0
    assert pii.redact(texts[2], brute_spans(texts[2])) == "[email] and [phone] here"


def test_field_finds_what_the_patterns_miss_in_the_corpus(spark):
    docs = common.table(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.where("doc_id < 2500").collect()]
    model = pii.train(pii.labelled_table() + pii.corpus_table(docs))
    r, hit, number = random.Random(77), Counter(), Counter()
    for _, text in rows:
        for kind, a, b in pii.base_spans(text or ""):
            new = " ".join(pii.variant(kind, text[a:b], r))
            changed = f"{text[:a]}{new}{text[b:]}"
            base = pii.base_spans(changed)
            spans = [(x, y) for k, x, y in base + pii.added_spans([changed], model, [base])[0] if k == kind]
            number[kind] += 1
            hit[kind] += any(x <= a + len(new) - 4 and y >= a + len(new) - 1 for x, y in spans)
    assert all(number[k] >= 10 and hit[k] >= 0.9 * number[k] for k in pii.KINDS), (hit, number)
    found = pii.find(docs).join(docs, "doc_id").where("n_added > 0").collect()
    assert len(found) >= 200
    for row in found:
        base = {s for s in map(tuple, pii.base_spans(row["text"]))}
        extra = [s for s in (x.split(":") for x in row["spans"].split(",")) if (s[0], int(s[1]), int(s[2])) not in base]
        assert len(extra) == row["n_added"] == row["n_spans"] - len(base)
        for kind, a, b in extra:
            assert pii.plausible(kind, row["text"][int(a) : int(b)])


def test_lines_with_spans_take_linear_time():
    model, line = pii.train(pii.labelled_table()), "write to anna (at) mail7 (dot) org please\n"
    took = []
    for n in (2_000, 20_000):
        began = time.time()
        assert len(pii.added_spans([line * n], model, [[]])[0]) == n
        took.append(time.time() - began)
    assert took[1] < 30 * max(took[0], 0.05)


def test_rates_against_plain_projected_gradient(spark):
    r = np.random.default_rng(0)
    n, p = r.integers(0, 900, 500), r.dirichlet([0.3, 0.3, 0.3], 500)
    state = spark.createDataFrame([(k, int(a), b.tolist()) for k, (a, b) in enumerate(zip(n, p))], "doc_id long, n_tokens long, p array<double>").repartition(3)
    weights = {"a": 0.6, "b": 0.3, "c": 0.1}
    for least, budget in ((0.0, 1.0), (1.0, None), (0.0, 2.5)):
        found = mixing.fit(state, weights, ("a", "b", "c"), budget, least)
        u, t = n / n.sum(), np.array([0.6, 0.3, 0.1])
        s = u @ p
        t = t * (budget if budget is not None else (s / t).max())
        x = np.ones(500)
        for _ in range(3000):
            x = np.maximum(least, x - ((p @ (((u * x) @ p - t) / s)) + 1e-3 * (x - 1)) / 1.001)
        got = found.rates(p)
        assert np.abs((u * got) @ p - (u * x) @ p).max() < 2e-3 and got.min() >= least
        assert np.allclose(found.reached, (u * got) @ p, atol=1e-4)
        rated = mixing.with_rates(state, found).orderBy("doc_id").collect()
        assert np.allclose([x["rate"] for x in rated], got) and all(abs(x["copies"] - x["rate"]) < 1 for x in rated)
    assert abs(sum(x["copies"] for x in rated) / got.sum() - 1) < 0.1


def test_fit_says_when_rounds_run_out(spark, monkeypatch):
    r = np.random.default_rng(1)
    rows = [(k, int(n), p.tolist()) for k, (n, p) in enumerate(zip(r.integers(1, 900, 200), r.dirichlet([0.3, 0.3], 200)))]
    state = common.cut(spark.createDataFrame(rows, "doc_id long, n_tokens long, p array<double>"))
    with pytest.warns(RuntimeWarning, match="2 rounds ran out"):
        assert not mixing.fit(state, {"a": 0.9, "b": 0.1}, ("a", "b"), rounds=2).settled
    assert mixing.fit(state, {"a": 0.9, "b": 0.1}, ("a", "b"), rounds=400).settled
    asked = {}
    monkeypatch.setattr(mixing, "fit", lambda *a, **k: asked.update(k) or mixing.Fit((), 1e-3, 1.0, 0.0, (), (), ()))
    docs = spark.createDataFrame([(1, "a b", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    monkeypatch.setattr(corpus_pipeline, "labelled_domains", lambda *a: docs.selectExpr("doc_id", "text", "lang AS domain"))
    corpus_pipeline.mixed(spark, docs, "")
    assert asked["tolerance"] == 1e-6


def test_mixture_meets_targets(spark):
    docs = common.table(spark, SF, "documents")
    labelled = docs.where("doc_id % 7 = 0").select("doc_id", "text", F.col("lang").alias("domain"))
    weights = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
    rows = mixing.mix(docs, labelled, weights).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    tokens = rows.rate * rows.n_tokens
    for d, w in weights.items():
        assert abs((tokens * rows[f"p_{d}"]).sum() / rows.n_tokens.sum() - w) < 0.01
        assert abs((rows.copies * rows.n_tokens)[rows.lang == d].sum() / rows.n_tokens.sum() - w) < 0.06
    out = mixing.mixed(docs, labelled, weights)
    counts = Counter(r["doc_id"] for r in out.select("doc_id").collect())
    assert counts == {i: c for i, c in zip(rows.doc_id, rows.copies) if c}


def test_written_out_addresses_need_a_domain():
    """An at within prose is none, whatever the field labels."""
    yes = ["ana at host dot com", "ana.b (at) host.org", "a.b [at] host [dot] example [dot] net", "a7 {at} h1 {dot} de", "x@host.com"]
    no = ["ing. At at heorea re", "ing. At heorea re", "end. at host dot com", "ana at host", "ana at host com", "ana at at host dot com", "at host dot com", "ana At host dot com", "ana at dot com", "12 at host dot 34"]
    assert all(pii.plausible("email", x) for x in yes)
    assert not any(pii.plausible("email", x) for x in no)
