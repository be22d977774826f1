"""Blocked search against a plain program, and the exactness of its tiles."""

import math
import random
import re

import numpy as np

from sessionlens.llm import lexical_search as search

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return _TERM.findall(lower)


def _brute(docs, items, k):
    listed = [(doc_id, _terms(text)) for doc_id, text in docs]
    n_docs, n_all = sum(bool(t) for _, t in listed), sum(len(t) for _, t in listed)
    found = {}
    for item, text in items:
        found.setdefault(item, set()).update(_terms(text))
    df = {t: sum(t in words for _, words in listed) for some in found.values() for t in some}
    rows = []
    for item, some in found.items():
        scored = []
        for doc_id, words in listed:
            score = 0
            for term in some:
                if tf := words.count(term):
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 50 + 50 * len(words) * n_docs // n_all
                    score += weight * (10**9 * tf // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, missing, doc_id) in enumerate(sorted(scored)[:k], 1):
            rows.append((item, rank, None if missing else doc_id, -score))
    return sorted(rows, key=str)


def _run(spark, docs, items, k=search.TOP, **options):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    listed = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, search.search(frame, listed, k=k, **options).collect()), key=str)


def _random_texts(seed, n, words=40):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["Éa", "éa", "ÉA", "9x", "日本"]
    seps = [" ", ", ", "\n", "-", "_"]
    return [
        "".join(r.choice(vocabulary) + r.choice(seps) for _ in range(r.randrange(30)))
        for _ in range(n)
    ]


def test_equals_a_plain_program(spark):
    docs = list(enumerate(_random_texts(1, 300), -20)) + [(900, None), (901, ""), (902, "...")]
    items = list(enumerate(_random_texts(2, 12))) + [(50, None), (51, "nowhere seen"), (52, "W1 w1")]
    assert _run(spark, docs, items, 7) == _brute(docs, items, 7)


def test_ties_repeated_rows_missing_ids_and_names(spark):
    docs = [(i, "same text here") for i in range(30)] + [(3, "same text here"), (None, "same")] * 2
    docs += [(100 + i, "something else") for i in range(60)]
    items = [(1, "text"), (1, "SAME"), (1, "SAME"), (None, "here")]
    assert _run(spark, docs, items, 33) == _brute(docs, items, 33)


def test_extra_columns_and_other_item_names(spark):
    docs = spark.createDataFrame(
        [(1, "a b", 5, "x", 1.5)], "doc_id long, text string, score int, item string, rank double"
    )
    items = spark.createDataFrame([("q", "b", 1)], "name string, body string, doc_id int")
    found = search.search(docs, items, item="name", text="body")
    assert found.columns == ["name", "rank", "doc_id", "score"]
    assert [tuple(r)[:3] for r in found.collect()] == [("q", 1, 1)]
    more = docs.unionByName(docs.selectExpr("2L doc_id", "'c' text", "1 score", "'' item", "0D rank"))
    assert [tuple(r)[:3] for r in search.search(more, items, "name", "body").collect()] == [("q", 1, 1)]


def test_empty_tables(spark):
    assert _run(spark, [], [(1, "a")]) == []
    assert _run(spark, [(1, "a")], []) == []
    assert _run(spark, [], []) == []


def test_a_very_long_text(spark):
    docs = [(1, "common " * 400_000 + "rare"), (2, "common"), (3, "other")]
    items = [(1, "rare common")]
    assert _run(spark, docs, items) == _brute(docs, items, 50)


def test_items_in_several_tiles(spark, monkeypatch):
    monkeypatch.setattr(search, "TILE_PAIRS", 20)
    docs, items = list(enumerate(_random_texts(3, 60))), list(enumerate(_random_texts(4, 15)))
    assert _run(spark, docs, items, 5) == _brute(docs, items, 5)


def test_tiles_stay_exact_at_the_bound():
    n_terms, weight = 3000, 44_000
    width = search.tile_width(np.array([weight]))
    assert width * weight * search.IMPACT_LIMIT < 2**53
    code = np.arange(n_terms)
    tile = search.ItemTile(
        ["q"], np.zeros(n_terms, np.int64), code, np.full(n_terms, weight), code, 1, 1
    )
    impact = np.full(n_terms, 999_999, np.int64)
    got = search.tile_scores(np.zeros(n_terms, np.int64), code, impact, 1, tile, width)
    assert got.tolist() == [[n_terms * weight * 999_999]]


def test_best_keeps_ties_by_id_whatever_the_tiles():
    r = random.Random(5)
    rows = [(r.randrange(4), r.randrange(1000)) for _ in range(500)]
    expected = sorted((-s, d) for s, d in rows if s > 0)[:40]
    for size in (1, 7, 50, 500):
        best = search.Best(1, 40)
        for start in range(0, 500, size):
            part = rows[start:start + size]
            best.offer(
                np.array([[s] for s, _ in part]),
                np.array([d for _, d in part]),
                np.zeros(len(part), bool),
            )
        assert sorted(zip((-best.score).tolist(), best.doc.tolist())) == expected


def test_wide_products_do_not_overflow():
    n = np.array([2**40, 3], np.int64)
    got = search.impacts(np.array([5, 1]), n, 2**30, 2**45)
    expected = [
        10**9 * tf // (1000 * tf + 20 * (50 + 50 * int(k) * 2**30 // 2**45))
        for tf, k in zip((5, 1), n)
    ]
    assert got.tolist() == expected
