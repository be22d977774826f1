"""The learnt operators: held-out accuracy, defined cases, and the language model's maths."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sessionlens.llm import attention_quality, language_id, perplexity, toxicity
from sessionlens.llm.texts import id_remainder

from .conftest import needs_tables

SF01 = "/root/testdata/sf0.01"


def _tables(spark):
    return (spark.read.parquet(f"{SF01}/{name}.parquet") for name in ("documents", "labels"))


# ---- language ----------------------------------------------------------------------


@needs_tables
def test_languages_of_held_out_documents(spark, compiled):
    docs, _ = _tables(spark)
    model = language_id.fit(docs, id_remainder(3) != 1)
    held = docs.filter(id_remainder(3) == 1)
    right = language_id.with_language(held, model).filter("lang = lang_pred").count()
    assert right / held.count() > 0.98


def test_language_cases(docs, compiled):
    english, german = "the cat and the dog ", "der hund und die katze "
    rows = [(i, (english, german)[i % 2] * 3, ("en", "de")[i % 2], "a") for i in range(40)]
    model = language_id.fit(docs(rows), F.lit(True))
    odd = [None, "", "12 34 !?", "😀", english, german]
    made = language_id.with_language(docs(odd), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in made] == ["und"] * 4 + ["en", "de"]
    assert all(0 <= r.score <= 1 for r in made) and made[0].score == 0
    assert language_id.fit(docs([]), F.lit(True)) is None
    nothing = language_id.with_language(docs([english]), None).first()
    assert (nothing.lang_pred, nothing.score) == ("und", 0.0)
    alone = language_id.fit(docs([(1, english, "en", "a")]), F.lit(True))
    assert language_id.with_language(docs([german]), alone).first().lang_pred == "en"


def _plain_prediction(model, row):
    """The vote of one text, duel by duel."""

    def vote(voters):
        if len(voters.classes) == 1:
            return 0, 1.0
        votes, weakest = [0.0] * len(voters.classes), [math.inf] * len(voters.classes)
        for n, (a, b) in enumerate(voters.pairs):
            weights = voters.weights[:, n]
            margin = float(row @ weights[:-1] + weights[-1])
            for one, own in ((a, margin), (b, -margin)):
                votes[one] += (own > 0) + 0.01 * math.tanh(own)
                weakest[one] = min(weakest[one], own)
        best = max(range(len(votes)), key=lambda c: votes[c])
        return best, 1 / (1 + math.exp(-4 * max(-20, min(20, weakest[best]))))

    family, sure = vote(model.families)
    lang, also = vote(model.within[family])
    return model.within[family].classes[lang], sure * also


@needs_tables
def test_predictions_equal_duels_one_by_one(spark, compiled):
    docs, _ = _tables(spark)
    model = language_id.fit(docs, id_remainder(3) != 1, each=40)
    texts = [r.text for r in docs.orderBy("doc_id").limit(60).collect()] + [None, "7 8"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = language_id.with_language(frame, model).orderBy("doc_id").collect()
    for text, found in zip(texts, made):
        rows, letters = language_id.describe([text or ""])
        lang, score = _plain_prediction(model, rows[0]) if letters[0] else ("und", 0.0)
        assert found.lang_pred == lang
        assert found.score == pytest.approx(score, abs=1e-4)


def test_sample_of_languages_moves_no_text(spark, docs, compiled):
    rows = [(i, f"text {i}", ("en", "de", "fr")[i % 3], "a") for i in range(30)]
    rows += [(100 + i, "one more", "en", "a") for i in range(5)] + [(200, "x", None, "a")]
    sample = language_id.training_sample(docs(rows), F.lit(True), most_languages=2)
    # Equal counts: the first name is learnt.
    assert {r.lang for r in sample.collect()} == {"en", "de"}
    assert sample.count() == 25
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_features_of_the_sample(docs, compiled):
    sample = docs([(1, "ab", "en", "a"), (2, "12", "en", "a"), (3, None, "de", "a")])
    described = language_id.described_sample(sample.select("lang", "text").na.fill("")).collect()
    assert [r.lang for r in described] == ["en"]
    row = np.frombuffer(described[0].features, np.float32)
    assert np.array_equal(row, language_id.describe(["ab"])[0][0])


def test_families_come_first():
    langs = np.array(["en", "de", "fr", "es", "xx"] * 4, object)
    rows = np.eye(5, dtype=np.float32)[np.tile(np.arange(5), 4)]
    model = language_id.LanguageModel(rows, langs)
    assert model.families.classes == ["germanic", "romance", "xx"]
    assert model.predict(rows[:5])[0] == ["en", "de", "fr", "es", "xx"]


# ---- toxicity ----------------------------------------------------------------------


@needs_tables
def test_toxicity_of_held_out_documents(spark, compiled):
    docs, labels = _tables(spark)
    scored = toxicity.fit(docs, labels).score(docs).filter(id_remainder(5) == 0)
    rows = scored.join(labels, "doc_id").select("score", "toxic").collect()
    right = sum((r.score >= 0.5) == (r.toxic == 1) for r in rows)
    assert right / len(rows) > 0.9


def test_toxicity_cases(docs, spark, compiled):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    made = toxicity.fit(docs(["a"]), labels).score(docs([None, "", "idiot"]))
    assert [r.score for r in made.collect()] == [0.0, 0.0, 0.0]
    lexicon = toxicity.Lexicon({"vequ": 5.0, "rotter ": 4.0})
    kinds = [f[1:3] for f in lexicon.find("you idiot, idiots; vequta xvequ rotter rotters")]
    assert kinds == [
        ("you", "you"), ("insult", "idiot"), ("learnt", "vequ"), ("learnt", "rotter"),
    ]
    rows = toxicity.features(["", "You 1d1ot!", "IDIOT sooo", "x " * 50_000], lexicon)
    named = [dict(zip(toxicity.FEATURES, row)) for row in rows]
    assert not any(rows[0])
    assert named[1]["hidden"] > 0 and named[1]["obfuscated"] > 0 and named[1]["calls"] > 0
    assert named[2]["shouted"] > 0 and named[2]["stretched"] > 0 and named[2]["insults"] > 0


# ---- quality -----------------------------------------------------------------------


@needs_tables
def test_quality_of_held_out_documents(spark, compiled):
    docs, labels = _tables(spark)
    model = attention_quality.fit(docs, labels)
    held = attention_quality.score(docs, model).filter(id_remainder(5) == 0)
    rows = held.join(labels, "doc_id").select("score", "quality").collect()
    right = sum((r.score >= attention_quality.GOOD) == (r.quality == 1) for r in rows)
    assert right / len(rows) > 0.95


def test_slopes_are_those_of_the_loss():
    dice = np.random.default_rng(1)
    rows, counts = dice.normal(size=(9, 3)), np.array([2, 4, 3])
    labels = np.array([1.0, 0.0, 1.0])
    model = attention_quality.AttentionModel(rows)
    slopes = model._slopes(rows, counts, labels)

    def loss():
        p = model.forward(rows, counts)["p"]
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for name, weights in model.weights.items():
        place = (0,) * weights.ndim
        weights[place] += 1e-5
        up = loss()
        weights[place] -= 2e-5
        down = loss()
        weights[place] += 1e-5
        assert slopes[name][place] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_quality_cases(docs, spark, compiled):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert attention_quality.fit(docs(["a", "b"]), labels) in (0.0, 1.0)
    rows, counts = attention_quality.passages(["", " \n", "a b", "w " * 1000])
    assert counts.tolist() == [1, 1, 1, 16] and np.isfinite(rows).all()
    model = attention_quality.AttentionModel(rows)
    made = attention_quality.score(docs([None, "", "a b", "a b"]), model).orderBy("doc_id")
    scores = [r.score for r in made.collect()]
    assert scores[0] == scores[1] and scores[2] == scores[3]


# ---- perplexity --------------------------------------------------------------------


def _naive_base(text):
    text = text or ""
    words = [w for w in text.translate({c: 32 for c in range(9, 14)}).split(" ") if w]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    again = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 8)}
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\f\r")]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(again),
    }


def test_base_counts_equal_plain_ones():
    dice = random.Random(4)
    texts = ["", " ", "\n\n \n", "a", "é\xa0b \x1cc", "x\x0by\fz\r\nx\x0by\fz\r\n", "go on " * 40]
    for _ in range(60):
        parts = dice.choices(["a", "b", "#|", "\n", "\t", "c d", "é"], k=dice.randrange(90))
        texts.append(" ".join(parts))
    found = perplexity.base_counts(texts)
    for n, text in enumerate(texts):
        assert {k: int(v[n]) for k, v in found.items()} == _naive_base(text), text


def _naive_model(texts):
    """Probability of a character after its context, straight from the definition."""
    order = perplexity.ORDER
    counts = {order: {}}
    times = {}
    for text in texts:
        padded = perplexity.START * (order - 1) + text
        for i in range(order - 1, len(padded)):
            gram = padded[i - order + 1:i + 1]
            counts[order][gram] = counts[order].get(gram, 0) + 1
            for k in range(order):
                times[gram[k:]] = times.get(gram[k:], 0) + 1
    for size in range(order - 1, 0, -1):
        counts[size] = {}
        for gram in counts[size + 1]:
            counts[size][gram[1:]] = counts[size].get(gram[1:], 0) + 1

    def discount(size, n):
        have = [sum(c == k for c in counts[size].values()) for k in (1, 2, 3, 4)]
        k = min(n, 3)
        if not all(have):
            return 0.5 + 0.25 * (k - 1)
        y = have[0] / (have[0] + 2 * have[1])
        return max(0.1, min(k - (k + 1) * y * have[k] / have[k - 1], k * 0.95))

    def parts(gram):
        size = len(gram)
        same = {g: c for g, c in counts[size].items() if g[:-1] == gram[:-1]}
        total = sum(same.values())
        n = same.get(gram, 0)
        own = (n - discount(size, n)) / total if n else 0
        return own, sum(discount(size, c) for c in same.values()) / total if same else 1

    def whole(gram):
        if not gram:
            return 1 / len(counts[1])
        own, weight = parts(gram)
        return own + weight * whole(gram[1:])

    def p(gram):
        if len(gram) == 1 or times.get(gram, 0) > 1:
            return whole(gram)
        return parts(gram)[1] * p(gram[1:])

    return p


def test_model_equals_the_definition(docs, compiled):
    dice = random.Random(8)
    texts = ["".join(dice.choices("abcd é", k=dice.randrange(1, 80))) for _ in range(40)]
    counts = perplexity.count_grams(docs(texts))
    hashed = perplexity.hashed_tables(perplexity.model_tables(counts))
    model = perplexity.hashed_model(hashed)
    p = _naive_model(texts)
    some = [*texts[:10], "dcba", "a"]
    found = model.log_perplexity(some, ["en"] * len(some))
    for text, value in zip(some, found):
        padded = perplexity.START * (perplexity.ORDER - 1) + text
        logs = [math.log(p(padded[i:i + perplexity.ORDER])) for i in range(len(text))]
        assert value == pytest.approx(-sum(logs) / len(text), abs=1e-4)


def test_no_two_of_many_grams_share_an_entry(docs, compiled):
    """A hundred thousand different n-grams: each is found with its own value, no other is."""
    import numpy as np

    dice = np.random.default_rng(5)
    flat = dice.integers(0x21, 0x3000, (100_000, perplexity.ORDER)).astype(np.uint32)
    flat[::3, 0] += 0x10000  # beyond the first plane
    flat = np.unique(flat, axis=0)
    keys = perplexity._keys(perplexity._rolled(flat.ravel(), perplexity.ORDER)[::perplexity.ORDER], np.uint64(7))
    assert len(np.unique(keys)) == len(flat)
    known, values = keys[::2], np.arange(len(keys[::2]), dtype=np.float32)
    model = perplexity.HashedModel(lambda size, kind: (known, values))
    found, has = model._look_up((1, "p"), keys)
    assert has[::2].all() and not has[1::2].any()
    assert (found[::2] == values).all()


def test_passes_and_small_counters_change_nothing(docs, compiled, monkeypatch):
    dice = random.Random(9)
    rows = [
        (i, "".join(dice.choices("abcd é", k=dice.randrange(1, 200))), f"l{i % 5}", "a")
        for i in range(60)
    ]
    whole = sorted(map(tuple, perplexity.judge(docs(rows)).collect()))
    monkeypatch.setattr(perplexity, "PASS_VALUES", 500)
    monkeypatch.setattr(perplexity, "_HELD", 40)
    again = sorted(map(tuple, perplexity.judge(docs(rows)).collect()))
    assert [r[:6] for r in again] == [r[:6] for r in whole]
    assert all(abs(a[6] - b[6]) < 1e-5 for a, b in zip(again, whole))


def test_bands_equal_a_plain_program(docs, compiled):
    dice = random.Random(10)
    words = ["".join(dice.choices("abcdefgh", k=4)) for _ in range(80)]
    rows = [(i, " ".join(dice.choices(words, k=dice.randrange(20, 90))), "en", "a") for i in range(41)]
    rows += [(90, " ".join("".join(dice.choices("xyz", k=5)) for _ in range(50)), "en", "a")]
    made = perplexity.judge(docs(rows)).collect()
    values = sorted(r.log_perplexity for r in made if r.n_words >= perplexity.LEAST_WORDS)
    middle = values[(len(values) - 1) // 2]
    spread = sorted(abs(x - middle) for x in values)[(len(values) - 1) // 2]
    reach = max(spread * perplexity.WIDTH, perplexity.LEAST_REACH)
    for r in made:
        wide = reach * math.sqrt(1 + perplexity.SHORT_WORDS / max(r.n_words, 1))
        inside = abs(r.log_perplexity - middle) <= wide
        assert r.in_band == inside and r.kept == (inside and not r.base_failed)


def test_rules_reject_strange_texts_and_keep_the_rest(docs, compiled):
    dice = random.Random(6)
    words = ["".join(dice.choices("abcdefgh", k=5)) for _ in range(300)]
    rows = [(i, " ".join(dice.choices(words, k=60)), "en", "a") for i in range(80)]
    strange = " ".join("".join(dice.choices("qxzjkv19", k=7)) for _ in range(60))
    rows += [(100, strange, "en", "a"), (101, None, None, None), (102, "short", "en", "a")]
    rows += [(103, "same words over and over again and again " * 9, "en", "a")]
    made = {r.doc_id: r for r in perplexity.judge(docs(rows)).collect()}
    assert all(made[i].kept for i in range(80))
    assert not made[100].kept and not made[100].base_failed
    assert made[101].base_failed and made[102].base_failed and made[103].base_failed
    assert perplexity.judge(docs([])).count() == 0
