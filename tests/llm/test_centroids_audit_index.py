"""Centroid clustering, filter audit and positional index against brute force, and on odd tables."""

import hashlib
import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import centroids, filter_audit, positional_index

VECTORS = "vec_id long, embedding array<float>, label int"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# ---- 11 centroids ----------------------------------------------------------------
def _lloyd(rows, k, rounds, dims, scale, seed):
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cs = [v for _, v in start[:k]]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((dist(v, c), j) for j, c in enumerate(cs))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in kept]
        cs = [[sum(col) // len(col) for col in zip(*(v for (_, v), a in zip(kept, of) if a == j))] if j in of else c
              for j, c in enumerate(cs)]
    last = [(i, *near(v)[::-1]) for i, v in kept]
    by = {j: sum(d for _, a, d in last if a == j) for j in range(len(cs))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    return sorted(((i, a, d, by[a], sum(by.values()), sha[a]) for i, a, d in last), key=str)


@pytest.mark.parametrize("block", [1, 2, 3, 7])
def test_clusters_equal_plain_rounds(spark, block):
    rng = random.Random(block)
    hot = [rng.uniform(-1, 1) for _ in range(7)]
    rows = [(i, hot if i % 3 == 0 else [rng.gauss(i % 5, 0.4) for _ in range(7)]) for i in range(400)]
    rows += [(500, [1e-3] * 7), (500, [1e-3] * 7), (501, None), (502, [1.0] * 6), (503, [None] + [0.0] * 6),
             (504, [float("nan")] + [0.0] * 6), (505, [float("inf")] + [0.0] * 6)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).withColumn("cluster", F.lit("clash")).repartition(3)
    out = centroids.cluster_vectors(df, k=9, rounds=3, dims=7, scale=256, seed=2, block=block).collect()
    got = sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in out), key=str)
    assert got == _lloyd(rows, 9, 3, 7, 256, 2)


def test_dictionaries_lose_nothing_whatever_the_chunk(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-2.0, 0.25, 3.5, 400.0]) for _ in range(5)], 0) for i in range(100)]
    whole = centroids.whole_vectors(spark.createDataFrame(rows, VECTORS).coalesce(2), 5, 256)
    want = sorted((r.vec_id, tuple(r.v)) for r in whole.collect())
    for chunk in (1, 7, 50, 1000):
        chunks = centroids.encode_chunks(whole, 5, 2, chunk).toArrow().to_batches()
        got = []
        for batch in chunks:
            for ids, books, codes in centroids._decoded(batch, 5, 2):
                assert len(ids) <= chunk and all(len(np.unique(b, axis=0)) == len(b) for b in books)
                v = np.concatenate([book[code] for book, code in zip(books, codes)], axis=1)
                got += [(i, tuple(x)) for i, x in zip(ids.to_pylist(), v.tolist())]
        assert sorted(got) == want


def test_clusters_on_small_odd_and_empty_tables(spark):
    assert centroids.cluster_vectors(spark.createDataFrame([], VECTORS)).collect() == []
    rows = [(None, [0.5] * 64, 1), (1, [0.25] * 64, 1), (1, [0.25] * 64, None)]
    out = centroids.cluster_vectors(spark.createDataFrame(rows, VECTORS)).collect()
    assert sorted(r.distance for r in out) == [0, 0, 0] and {r.vec_id for r in out} == {None, 1}
    with pytest.raises(Exception, match="too large"):
        centroids.cluster_vectors(spark.createDataFrame([(1, [1e9] * 64, 1)], VECTORS)).collect()


# ---- 12 filter audit ---------------------------------------------------------------
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _audit(docs, labels):
    def letters(i, text):
        words = WORD.findall(text)
        return {x for x, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            bool(re.search("[#$%&*|]", text)),
            i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs))) if bad}

    rows = [(lang or "", letters(i, t or ""), i) for i, t, lang in docs]
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = {}
    for part in {p for p, _, _ in rows}:
        mine = [(f, i) for p, f, i in rows if p == part]
        for order in map("".join, permutations("ABCDE")):
            alive = mine
            for step, x in enumerate(order, 1):
                gone = [r for r in alive if x in r[0]]
                out[part, order, step] = [len(alive) - len(gone), len(gone), sum(x in f for f, _ in mine) - len(gone),
                                          sum(f == {x} for f, _ in mine), sum(i in good for _, i in gone),
                                          sum(i in toxic for _, i in gone)]
                alive = [r for r in alive if x not in r[0]]
    shapley = {}
    for (part, order, step), c in out.items():
        shapley[part, order[step - 1]] = shapley.get((part, order[step - 1]), 0) + c[1]
    return {k: (*c, shapley[k[0], k[1][k[2] - 1]]) for k, c in out.items()}


def test_audit_equals_plain_walks(spark):
    rng = random.Random(8)
    plain = lambda n, m: " ".join(f"w{rng.randrange(m)}" for _ in range(n))
    texts = [plain(rng.choice([20, 199, 200, 300]), rng.choice([30, 100, 5000])) + rng.choice(["", " #", " A B C D" * 9, "é" * 50])
             for _ in range(60)] + ["", None, " \t\n", "x | y"]
    docs = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""])) for i in range(300)]
    docs += [(None, texts[0], "en"), (None, texts[0], "en"), (7, docs[7][1], "fr"), (7, docs[7][1], docs[7][2])]
    labels = [(rng.randrange(320), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(200)] + [(None, 1, 1)]
    df = spark.createDataFrame([(i, t, lang, "s", 1) for i, t, lang in docs], DOCS).select(
        "*", *(F.lit("clash").alias(c) for c in ("part", "failed", "digest", "good", "n", "step")))
    out = filter_audit.audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    got = {(r.part, r.filter_order, r.step): tuple(r[c] for c in [*filter_audit.COUNTS, "shapley"]) for r in out}
    assert len(out) == len(got) and got == _audit(docs, labels)


def test_audit_of_no_documents_and_no_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(spark.createDataFrame([], DOCS), labels).collect() == []
    out = filter_audit.audit(spark.createDataFrame([(1, None, None, None, None)], DOCS), labels).collect()
    assert len(out) == 600 and {r.part for r in out} == {""}


# ---- 13 positional index --------------------------------------------------------------
def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _leaks(docs, bench):
    out = []
    for i, text in docs:
        w, hit, items = _words(text), set(), set()
        for item, t in bench:
            b = _words(t)
            n = min(10, len(b))
            wins = {tuple(b[a:a + n]) for a in range(len(b) - n + 1)} if n else set()
            for p in range(len(w) - n + 1):
                if n and tuple(w[p:p + n]) in wins:
                    hit |= set(range(p, p + n))
                    items |= {str(item)} if item is not None else set()
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("vocabulary", [2, 4, 40])
def test_leaks_equal_plain_search(spark, vocabulary):
    rng = random.Random(vocabulary)
    some = lambda n: [rng.choice("äbcdefghijklmnopqrst")[:1] + str(rng.randrange(vocabulary) // 20) if vocabulary > 20
                      else "abcd"[rng.randrange(vocabulary)] for _ in range(n)]
    bench = [(i, " ".join(some(rng.choice([1, 5, 9, 10, 11, 25, 60]) if vocabulary > 4 or i else 30))) for i in range(12)]
    bench = [b for b in bench if vocabulary > 4 or len(b[1].split()) > 9]
    bench += [(3, "The Quick-brown FOX"), (3, "a second text of item three"), (None, "an item that has no id at all, none"), (90, None), (91, " ,. ")]
    docs = []
    for i in range(60):
        w = some(rng.randrange(50))
        for _ in range(rng.randrange(3)):
            src = _words(rng.choice(bench)[1])
            a = rng.randrange(len(src) + 1)
            w[rng.randrange(len(w) + 1):0] = src[a:a + rng.choice([9, 10, 30])]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(w).title() if i % 2 else " ".join(w)))
    docs += [(None, None), (None, bench[0][1]), (70, ""), (7, docs[7][1]), (7, bench[0][1] + " x " + bench[0][1]), (71, "the quick brown fox")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], DOCS).select(
        "*", *(F.lit("clash").alias(c) for c in ("term", "pos", "k_id", "item", "n_hit", "words"))).repartition(3)
    out = positional_index.decontaminate(df, spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert sorted((tuple(r) for r in out), key=str) == _leaks(docs, bench)


def test_proximity_equals_plain_search(spark):
    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randrange(30)}" for _ in range(n))
    docs, bench = [(i, text(80)) for i in range(20)], [(i, text(14)) for i in range(5)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = positional_index.read_items(spark.createDataFrame(bench, "item_id long, text string"))
    index = positional_index.write_index(df, items)
    pairs = positional_index.rarest_pairs(index, items).collect()
    number = {r.item: int(r.item_id) for r in items.collect()}
    freq = {}
    for _, t in docs:
        for w in t.split():
            freq[w] = freq.get(w, 0) + 1
    windows = {(number[p.item], at): (p.qa, p.qb) for p in pairs for at in range(p.lo, p.hi - p.width + 2)}
    for (item, at), two in windows.items():
        b = bench[item][1].split()
        assert two == tuple(sorted(range(at, at + 10), key=lambda q: (freq[b[q]], q))[:2])
    assert len(windows) == sum(all(w in freq for w in t.split()[a:a + 10]) for _, t in bench for a in range(5))
    want = set()
    for p in pairs:
        for i, t in docs:
            w = t.split()
            for x in range(len(w)):
                for y in range(len(w)):
                    apart = (y - p.qb) - (x - p.qa)
                    if w[x] == p.ta and w[y] == p.tb and abs(apart) <= 2:
                        want.add((i, number[p.item], p.lo, p.hi, x - p.qa, apart))
    out = positional_index.proximity_matches(index, items, slop=2).collect()
    assert len(out) == len({(r.k_id, r.item, r.lo, r.hi, r.diag, r.apart) for r in out})
    assert {(r.k_id, number[r.item], r.lo, r.hi, r.diag, r.apart) for r in out} == want


def test_leaks_without_documents_or_benchmark(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "some words here", "en", "s", 1), (2, None, None, None, None)], DOCS)
    assert sorted((r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in positional_index.decontaminate(docs, bench).collect()) \
        == [(1, 3, 0, False), (2, 0, 0, False)]
    some = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert positional_index.decontaminate(spark.createDataFrame([], DOCS), some).collect() == []
    long = " ".join(f"w{i % 997}" for i in range(200_000)) + " some words"
    assert [r.n_hit for r in positional_index.decontaminate(spark.createDataFrame([(1, long, "en", "s", 1)], DOCS), some).collect()] == [2]
