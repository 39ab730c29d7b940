"""Decontamination: tiles, both ways of seeding, and edge cases."""

import random
import re

import numpy as np

from llm_tables import make_docs  # noqa: F401
from rowcast.llm import decontam as D

ITEM = " ".join(f"item{i}" for i in range(30))


def arr(words):
    return np.array([hash(w) & 0xFFFFFFFF for w in words], np.uint64)


def test_tiles_cover_reordered_passages():
    b = arr(f"w{i}" for i in range(20))
    x = arr(f"x{i}" for i in range(7))
    assert D.tile(np.concatenate([x, b[10:], x, b[:10]]), b, 5) == 20
    assert D.tile(np.concatenate([b[:4], x, b[4:8]]), b, 5) == 0
    assert D.tile(np.concatenate([b[:6], x, b[:6]]), b, 5) == 6
    assert D.tile(b[:3], b[:3], 5) == 3 and D.tile(x, b, 5) == 0 and D.tile(b[:0], b, 5) == 0


def test_tiles_equal_a_plain_search():
    rnd = random.Random(0)
    for _ in range(60):
        a, b = [rnd.randrange(4) for _ in range(rnd.randrange(60))], [rnd.randrange(4) for _ in range(rnd.randrange(30))]
        fa, fb, cover = [True] * len(a), [True] * len(b), 0
        while True:
            best = []
            for i in range(len(a)):
                for j in range(len(b)):
                    n = 0
                    while i + n < len(a) and j + n < len(b) and fa[i + n] and fb[j + n] and a[i + n] == b[j + n]:
                        n += 1
                    if n >= min(3, len(b)) and n:
                        best.append((n, i, j))
            if not best:
                break
            top = max(best)[0]
            for n, i, j in best:
                if n == top and all(fa[i:i + n]) and all(fb[j:j + n]):
                    fa[i:i + n], fb[j:j + n] = [False] * n, [False] * n
                    cover += n
        x, y = np.array(a, np.uint64) + 1, np.array(b, np.uint64) + 1
        assert D.tile(x, y, 3) == cover
        if len(b) and len(a) >= min(3, len(b)):
            assert D._tile_diagonals(x, y, min(3, len(b))) == cover


def test_repeated_words_in_bounded_memory():
    import tracemalloc

    a, b = np.full(1_000_000, 7, np.uint64), np.full(60, 7, np.uint64)
    tracemalloc.start()
    assert D.tile(a, b, 5) == 60
    assert D.tile(a[:200_000], np.tile(np.array([7, 7, 7, 9], np.uint64), 20), 3) == 60
    assert D.tile(np.tile(np.array([1, 2], np.uint64), 20_000), np.tile(np.array([2, 1], np.uint64), 30), 5) == 60
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()


def brute_force(docs, items):
    """Contaminating items of every document, by the definition: words, greedy
    tiles found by trying every pair of places, coverage of the item."""
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower())

    def covered(a, b):
        least, fa, fb, n_covered = min(5, len(b)), [True] * len(a), [True] * len(b), 0
        while True:
            best = []
            for i in range(len(a)):
                for j in range(len(b)):
                    n = 0
                    while i + n < len(a) and j + n < len(b) and fa[i + n] and fb[j + n] and a[i + n] == b[j + n]:
                        n += 1
                    if n >= least:
                        best.append((n, i, j))
            if not best:
                return n_covered
            top = max(best)[0]
            for n, i, j in best:
                if n == top and all(fa[i:i + n]) and all(fb[j:j + n]):
                    fa[i:i + n], fb[j:j + n] = [False] * n, [False] * n
                    n_covered += n
    out = []
    for doc_id, text in docs:
        own = {i: covered(words(text), w) / len(w) for i, t in items if (w := words(t))}
        bad = sorted(i for i, c in own.items() if c >= 0.5)
        out.append((doc_id, bool(bad), round(max(own.values(), default=0.0), 9), tuple(bad)))
    return sorted(out)


def test_query_against_brute_force(spark, make_docs):
    """Candidates, tiles and coverage together, both ways of seeding."""
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(12)]
    items = [(k, " ".join(rnd.choices(vocabulary, k=rnd.randrange(1, 25)))) for k in range(8)]
    docs = []
    for i in range(60):
        parts = [" ".join(rnd.choices(vocabulary + ["x", "y"], k=rnd.randrange(12))) for _ in range(3)]
        if i % 3:
            w = rnd.choice(items)[1].split()
            cut = rnd.randrange(len(w) + 1)
            parts.insert(1, " ".join(w[cut:] + ["mid"] * (i % 2) + w[:cut]).upper())
        docs.append((i, ", ".join(parts)))
    bench = spark.createDataFrame([(*x, "x") for x in items], "item_id long, text string, words string")
    want = brute_force(docs, items)
    assert 5 < sum(r[1] for r in want) < 60
    for limit in (D.MAX_WORDS, 0):
        got = D.contamination(make_docs(docs), bench, limit).collect()
        assert sorted((r.doc_id, r.contaminated, round(r.coverage, 9), tuple(r.item_ids)) for r in got) == want


def cases(spark, make_docs):
    words = ITEM.split()
    docs = make_docs([
        (1, "before " + ITEM.upper() + ", after"), (2, " ".join(words[15:] + ["mid"] * 9 + words[:15])),
        (3, "clean text " * 50), (4, " ".join(words[:12])), (5, ""), (6, None), (7, "y " * 100_000 + ITEM.replace(" ", "\n- ")),
        (8, "tiny item here"), (9, "nothing tiny"), (None, ITEM), (1, "clean"), (10, "Übung macht Meister"), (10, "ÜBUNG MACHT MEISTER")])
    bench = spark.createDataFrame([(0, ITEM, "x"), (1, "tiny item", "x"), (2, None, "x"), (3, " ,. ", "x"), (0, ITEM, "x"),
                                   (None, "nothing tiny", "x"), (4, "übung macht meister", "x")],
                                  "item_id long, text string, words string")
    return docs, bench


def test_both_ways_and_edges(spark, make_docs):
    docs, bench = cases(spark, make_docs)
    results = []
    for limit in (D.MAX_WORDS, 0):
        rows = sorted(((r.doc_id, r.contaminated, round(r.coverage, 6), tuple(r.item_ids))
                       for r in D.contamination(docs, bench, limit).collect()), key=str)
        kept = sorted((r.doc_id, r.text or "") for r in D.keep_clean(docs, bench, limit).collect())
        results.append((rows, kept))
    assert results[0] == results[1]
    rows, kept = results[0]
    bad = {(r[0], r[3]) for r in rows if r[1]}
    assert bad == {(1, (0,)), (2, (0,)), (7, (0,)), (8, (1,)), (9, ()), (None, (0,)), (10, (4,))}
    assert len(rows) == 13 and (4, False, 0.4, ()) in rows
    assert [k[0] for k in kept] == [1, 3, 4, 5, 6]
    assert D.keep_clean(docs, bench).columns == docs.columns
    for limit in (D.MAX_WORDS, 0):
        assert D.contamination(docs.limit(0), bench, limit).count() == 0
        assert D.contamination(docs, bench.limit(0), limit).where("contaminated").count() == 0
