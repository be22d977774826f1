"""Fingerprints and URL verdicts on small inputs."""

import hashlib

import pytest

from sessionlens.llm import imatch, urls
from sessionlens.llm.queries import URL_RULES


def _prints(frame):
    made = imatch.fingerprints(frame, least_share=0.1, most_share=0.9)
    return {r.doc_id: r for r in made.collect()}


def test_edited_texts_follow_the_order_of_ids(docs, compiled):
    texts = {5: "alpha beta gamma", 2: "beta", 9: None, 7: "é gamma delta alpha"}
    found = _prints(docs([(i, t, "en", "a") for i, t in texts.items()]))
    order = sorted(texts)
    for place, doc_id in enumerate(order):
        own = texts[doc_id] or ""
        following = texts[order[(place + 1) % len(order)]] or ""
        edited = own[:len(own) - len(own) // 2] + following[:len(own) // 2]
        assert found[doc_id].n_chars == len(own)
        assert found[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_equal_texts_are_alike_and_repeated_rows_stay(docs, compiled):
    text = "one two three four five six seven"
    rows = [(1, text, "en", "a"), (2, text, None, None), (2, text, None, None), (3, "", "en", "a")]
    made = imatch.fingerprints(docs(rows), least_share=0.1, most_share=1.0).collect()
    assert len(made) == 4
    assert len({r.fingerprint for r in made if r.doc_id < 3}) == 1
    first = next(r for r in made if r.doc_id == 1)
    assert first.near_next == 1.0 and 0 <= first.near_edited <= 1
    assert all(len(r.fingerprint) == imatch.SUBSETS * imatch.HASH_CHARS for r in made)


def test_ids_of_any_width_and_sign(docs, compiled, monkeypatch):
    monkeypatch.setattr(imatch, "BLOCK_ROWS", 3)
    ids = [-(2**63), -5, 0, 7, 10**15, 2**63 - 1]
    texts = {d: f"alpha beta w{n % 3} gamma" for n, d in enumerate(ids)}
    rows = [(d, t, "en", "a") for d, t in texts.items()]
    found = _prints(docs(rows[::-1]))
    for doc_id, following in zip(ids, ids[1:] + ids[:1]):
        own, other = texts[doc_id], texts[following]
        edited = own[:len(own) - len(own) // 2] + other[:len(own) // 2]
        assert found[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    # Null ids come first, ordered by their texts.
    made = imatch.fingerprints(docs([(None, "b", "en", "a"), (None, "ab", "en", "a"), *rows]))
    assert made.count() == len(rows) + 2


def test_blocks_do_not_change_the_result(docs, compiled, monkeypatch):
    rows = [(i * i, f"w{i % 5} w{i % 7} w{i % 3} common words here", "en", "a") for i in range(60)]
    whole = sorted(map(tuple, _prints(docs(rows)).values()))
    monkeypatch.setattr(imatch, "BLOCK_ROWS", 4)
    assert sorted(map(tuple, _prints(docs(rows)).values())) == whole


def test_empty_and_single_tables(docs, compiled):
    assert imatch.fingerprints(docs([])).count() == 0
    only = imatch.fingerprints(docs(["solo text"])).first()
    assert only.near_next == 1.0


def test_fingerprint_plan_has_no_python(docs, compiled):
    plan = imatch.fingerprints(docs(["a b"]))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_subsets_are_chosen_once_and_rows_stay_narrow(docs, compiled):
    plan = imatch.fingerprints(docs(["a b"]))._jdf.queryExecution().optimizedPlan().toString()
    # One choice of terms per side: a lambda computes an expression that it names twice twice.
    assert plan.count("getbit(") == 2
    # Terms are sorted by their own order, not by a lambda, and need no set.
    assert "array_sort(" not in plan and "collect_set(" not in plan


URLS = [
    ("http://www.Example.com/en/1?x#y", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://m.example.com/en/1", "m.example.com", "/en/1", "example.com/en/", "block"),
    ("http://m.example.com/de/casino", "m.example.com", "/de/casino", "com/", "allow"),
    ("https://a.net/fr/#z", "a.net", "/fr/", "net/fr/", "block"),
    ("https://notexample.org/en/", "notexample.org", "/en/", None, "allow"),
    ("http://example.com", "example.com", "", None, "allow"),
    ("http://x.org/casino-win", "x.org", "/casino-win", None, "block"),
    ("http://x.org/casinos", "x.org", "/casinos", None, "allow"),
    ("http://x.org/free-free-deal", "x.org", "/free-free-deal", None, "block"),
    ("http://x.org/free/free", "x.org", "/free/free", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
]


@pytest.mark.parametrize("url,host,path,rule,verdict", URLS)
def test_judged_urls(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, "x")], "page_id long, url string, host string")
    row = urls.judge_urls(pages, URL_RULES).first()
    assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict)


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge_urls(pages, URL_RULES).count() == 0
