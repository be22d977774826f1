"""The divergence audit against a plain program, and the quadtrees against full matrices."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from sessionlens.llm import divergence

_TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_SCHEMA = "text string, lang string, source string"


def _brute(rows, top=divergence.TOP_TERMS):
    groups, langs, held = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = _TERM.findall(lower)
        lang, source = lang or "", source or ""
        groups[lang, source].update(words)
        langs[lang].update(words)
        held[lang].update(set(words))
    kept = {lang: [t for t, n in held[lang].items() if n >= 3] for lang in langs}

    def price(counts, lang):
        total = sum(counts[t] for t in kept[lang]) + len(kept[lang])
        return {t: 1 + 10**9 * (counts[t] + 1) // total for t in kept[lang]}

    priced = {group: price(counts, group[0]) for group, counts in groups.items()}
    found = []
    for (lang, source), p in priced.items():
        q = price(langs[lang], lang)
        terms = [
            (-((p[t] - q[t]) ** 2 // q[t]), t)
            for t in p
            if groups[lang, source][t] and p[t] > q[t]
        ]
        pairs = [
            (-sum((p[t] - q[t]) ** 2 // q[t] for t in p), other)
            for (some, other), q in priced.items()
            if some == lang and other != source
        ]
        for part, ranked in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            for rank, (value, item) in enumerate(ranked, 1):
                found.append((lang, source, part, item, -value, rank))
    return sorted(found)


def _rows(seed, n=120, langs=2, sources=6, words=60):
    r = random.Random(seed)
    vocabulary = [c for i in range(words) if (c := "".join(chr(97 + int(d)) for d in str(i)))]
    vocabulary += ["Éa", "éa", "日本", "x2y"]
    return [
        (
            " ".join(r.choices(vocabulary, k=r.randrange(25))),
            f"l{r.randrange(langs)}",
            f"s{int(r.random() ** 2 * sources)}",
        )
        for _ in range(n)
    ]


def _run(spark, rows, **options):
    frame = spark.createDataFrame(rows, _SCHEMA)
    return sorted(map(tuple, divergence.audit(frame, **options).collect()))


def test_equals_a_plain_program(spark):
    rows = _rows(1) + [(None, "l0", "s1"), ("", "l0", "alone"), ("a b", None, None), (None,) * 3]
    rows += [("once only", "l9", f"t{i}") for i in range(2)]  # no kept term: values are 0
    assert _run(spark, rows) == _brute(rows)
    assert _run(spark, rows, top=3) == _brute(rows, 3)


@pytest.mark.parametrize("cells, terms, groups", [(7, 5, 2), (40, 4096, 3), (10**6, 3, 256)])
def test_small_blocks_change_nothing(spark, monkeypatch, cells, terms, groups):
    monkeypatch.setattr(divergence, "BLOCK_CELLS", cells)
    monkeypatch.setattr(divergence, "BLOCK_TERMS", terms)
    monkeypatch.setattr(divergence, "BLOCK_GROUPS", groups)
    monkeypatch.setattr(divergence, "BROADCAST_LANGUAGES", 1)
    rows = _rows(2, n=80, words=25)
    assert _run(spark, rows) == _brute(rows)


def test_a_full_counter_is_given_back(spark, monkeypatch):
    rows = _rows(3, n=60)
    expected = _brute(rows)
    found = divergence.term_counts(spark.createDataFrame(rows, _SCHEMA))
    monkeypatch.setattr(divergence, "HELD", 5)
    again = divergence.term_counts(spark.createDataFrame(rows, _SCHEMA))
    assert sorted(map(str, again.collect())) == sorted(map(str, found.collect()))
    assert _run(spark, rows) == expected


def test_ties_and_repeated_rows(spark):
    rows = [("zeta alpha Beta", "l", s) for s in ("a", "b", "c")] * 3
    found = _run(spark, rows)
    assert found == _brute(rows)
    assert {r[4] for r in found} == {0}


def test_empty_table_and_extra_columns(spark):
    assert _run(spark, []) == []
    rows = [("a b c", "l", "s")] * 3 + [("a a", "l", "t")]
    frame = spark.createDataFrame(
        [(*r, 1, "x", 2) for r in rows], f"{_SCHEMA}, term int, item string, n int"
    )
    assert sorted(map(tuple, divergence.audit(frame).collect())) == _brute(rows)


def test_a_very_long_text(spark):
    rows = [("word " * 300_000, "l", "s"), ("word other", "l", "t"), ("word", "l", "t")]
    assert _run(spark, rows) == _brute(rows)


def test_prices_are_exact_for_large_counts():
    counts, total, n_terms = [0, 5, 10**13, 7 * 10**15], 8 * 10**15, 12345
    got = divergence.prices(np.array(counts), total, n_terms)
    assert got.tolist() == [1 + 10**9 * (c + 1) // (total + n_terms) for c in counts]
    with pytest.raises(OverflowError):
        divergence.prices(np.array([1]), 10**16, 1)


@pytest.mark.parametrize("portion", [1, 10, 10**6])
def test_walk_meets_every_pair_and_column_once(monkeypatch, portion):
    monkeypatch.setattr(divergence, "PORTION", portion)
    r = np.random.default_rng(4)
    for shape in ((1, 1, 1), (5, 3, 9), (2, 7, 30), (6, 6, 17)):
        dense = [(r.random((n, shape[2])) < share) for n, share in zip(shape, (0.05, 0.3))]
        height = int(max(shape) - 1).bit_length()
        trees = [divergence.Quadtree(*np.nonzero(m), height) for m in dense]
        seen = np.zeros((*shape[:2], 2), int)
        for kind, level, a, b, *rest in divergence.joint_walk(*trees, height, shape, False):
            size = 1 << level
            for i in range(len(a)):
                if kind == "cells":
                    seen[a[i], b[i], 0] += 1
                else:
                    columns = slice(rest[0][i] * size, (rest[0][i] + 1) * size)
                    rows = slice(a[i] * size, (a[i] + 1) * size)
                    others = slice(b[i] * size, (b[i] + 1) * size)
                    assert not dense[0][rows, columns].any() and not dense[1][others, columns].any()
                    seen[rows, others, 1] += min(columns.stop, shape[2]) - columns.start
        either = (dense[0][:, None] | dense[1][None]).sum(axis=2)
        assert (seen[..., 0] == either).all()
        assert (seen.sum(axis=2) == shape[2]).all()
