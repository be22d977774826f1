"""The join against all pairs compared one by one."""

import random

import numpy as np

from sessionlens.llm import jaccard_join as j
from sessionlens.llm.components import components
from sessionlens.llm.words import shingle_sets


def _shingles(text):
    words = (text or "").split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def _brute(rows):
    """doc row number -> (class id, links, copies), by comparing all pairs."""
    sets = [_shingles(text) for _, text in rows]
    root = list(range(len(rows)))
    links, copies = [0] * len(rows), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if common >= 0.8 * len(sets[a] | sets[b]):
                    for x in (a, b):
                        links[x] += 1
                        copies[x] += sets[a] == sets[b]
                    root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for n, (doc_id, _) in enumerate(rows):
        least[find(n)] = min(least.get(find(n), doc_id), doc_id)
    return sorted((d, least[find(n)], links[n], copies[n]) for n, (d, _) in enumerate(rows))


def _texts():
    dice = random.Random(5)
    word = lambda: "".join(dice.choices("abcdefgh", k=4))
    texts = [None, "", " \n", "one two", "one  two", "one", "a b c d e"]
    for _ in range(12):
        base = [word() for _ in range(dice.randrange(20, 160))]
        texts += [" ".join(base), " ".join(base)]
        for _ in range(5):
            near = list(base)
            for _ in range(dice.randrange(1, 4)):
                near[dice.randrange(len(near))] = word()
            texts.append(" ".join(near))
    texts.append("x y z " * 4000)
    dice.shuffle(texts)
    return [(n * 7 % 1009, text) for n, text in enumerate(texts)]


def _found(frame):
    return sorted((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in frame.collect())


def test_join_equals_all_pairs(docs, compiled, monkeypatch):
    rows = _texts()
    frame = docs([(doc_id, text, "en", "a") for doc_id, text in rows])
    assert _found(j.jaccard_classes(frame)) == _brute(rows)
    # Small blocks: every bucket is split, every pair of blocks meets once.
    monkeypatch.setattr(j, "BLOCK", 3)
    assert _found(j.jaccard_classes(frame)) == _brute(rows)


def test_one_of_each_class_and_empty_tables(docs, compiled):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(3, text, "en", "a"), (1, text, "en", "b"), (1, text, "en", "b"), (2, "other", None, None)]
    kept = j.one_of_each_class(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert j.jaccard_classes(docs([])).count() == 0
    assert j.one_of_each_class(docs([])).count() == 0


def test_texts_that_share_a_doc_id_keep_their_links(docs, compiled):
    text = " ".join(f"w{i}" for i in range(60))
    near, other = text + " more", " ".join(f"x{i}" for i in range(60))
    for rows in (
        [(1, text), (1, other), (2, near)],
        [(1, other), (1, text), (2, near)],
        [(None, other), (None, text), (None, near), (None, text), (4, near)],
        [(-(2**63), text), (2**63 - 1, near), (2**63 - 1, other)],
    ):
        found = j.jaccard_classes(docs([(d, t, "en", "a") for d, t in rows])).collect()
        links = sorted(r.n_links for r in found)
        texts = [t for _, t in rows if t != other]
        assert links == sorted([len(texts) - 1] * len(texts) + [0] * (len(rows) - len(texts)))
        kept = j.one_of_each_class(docs([(d, t, "en", "a") for d, t in rows])).collect()
        assert len(kept) == 2 and {r.text == other for r in kept} == {True, False}


def test_documents_without_words_all_stay(docs, compiled):
    rows = [(1, None, "en", "a"), (1, "", "en", "a"), (2, " ", "en", "a"), (2, " ", "en", "a")]
    kept = j.one_of_each_class(docs(rows)).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == [(1, ""), (1, ""), (2, " ")]


def test_extra_columns_with_names_of_the_join(docs, compiled):
    rows = docs([(1, "a b c d e f", "en", "a"), (2, "a b c d e f", "en", "b")])
    rows = rows.selectExpr("*", "5 AS kept", "6 AS text_hash", "7 AS Key", "8 AS root")
    kept = j.one_of_each_class(rows).collect()
    assert [(r.doc_id, r.kept, r.text_hash, r.Key, r.root) for r in kept] == [(1, 5, 6, 7, 8)]


def test_posterior_and_bands():
    needed = [j.least_matches(n, 0.8, 1e-6) for n in (32, 64, 96, 128)]
    assert needed == sorted(needed) and 0 < needed[0] < 26 and needed[-1] < 103
    same, other = shingle_sets(["a b c d e f g h", "q r s t u v w x"])
    signatures = np.stack([j.signature(same), j.signature(same), j.signature(other)])
    assert j.likely_pairs(signatures[[0, 0]], signatures[[1, 2]], 0.8, 1e-6).tolist() == [0]
    bands = j.band_hashes(signatures)
    assert (bands[0] == bands[1]).all() and not (bands[0] == bands[2]).any()


def test_components_of_chains_and_stars(spark, compiled):
    edges = [(f"{i:03}", f"{i + 1:03}") for i in range(40)] + [("a0", f"a{i}") for i in range(1, 9)]
    edges += [("b", "b"), ("a1", "a2")]
    found = components(spark.createDataFrame(edges, "a string, b string")).collect()
    roots = {r.node: r.root for r in found}
    assert roots == {f"{i:03}": "000" for i in range(1, 41)} | {f"a{i}": "a0" for i in range(1, 9)}
