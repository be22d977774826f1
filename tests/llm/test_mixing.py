"""Mixing against a plain program over the same shares and places."""

import hashlib
import math

import duckdb
import pytest

import oracle_check
from sessionlens.llm import mixing, oracles, queries


def _tokens(text):
    return 0 if not text else text.count(" ") + text.count("\n") + 1


def _place(seed, number, doc_id):
    digest = hashlib.md5(f"{seed}:{number}:{doc_id}".encode()).hexdigest()
    return int(digest[:15], 16)


def _weights(tokens, a):
    total = sum(tokens.values())
    w = {s: (t / total) ** a for s, t in tokens.items()}
    z = sum(w.values())
    return {s: x / z for s, x in w.items()}


def _entropy(weights):
    return -sum(w * math.log(w) for w in weights.values())


def _brute(rows, target):
    tokens = {}
    for doc_id, source, text in rows:
        tokens[source or ""] = tokens.get(source or "", 0) + _tokens(text)
    tokens = {s: t for s, t in tokens.items() if t}
    total = sum(tokens.values())

    def budget(a):
        w = _weights(tokens, a)
        if target.min_passes:
            return target.min_passes / min(w[s] / tokens[s] for s in tokens)
        return float(total)

    def beyond(a):
        w = _weights(tokens, a)
        often = max(w[s] * budget(a) / tokens[s] for s in tokens) > target.max_repeats * (1 + 1e-12)
        return often or _entropy(w) > target.entropy * math.log(len(tokens))

    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if beyond(middle) else (low, middle)
    a = 0.0 if not beyond(0.0) else 1.0 if beyond(1.0) else high
    w, whole = _weights(tokens, a), budget(a)
    copies = {}
    for source, t in tokens.items():
        passes, rest = divmod(round(w[source] * whole), t)
        own = sorted(
            (_place(target.seed, passes, d), d, _tokens(x)) for d, s, x in rows if (s or "") == source
        )
        used = 0
        for _, doc_id, n in own:
            used += n
            copies[doc_id] = passes + (0 < rest and used <= rest)
    return {d: c for d, c in copies.items() if c}


def _rows():
    rows, doc_id = [], 0
    for source, count in (("big", 120), ("mid", 30), ("small", 9), (None, 4)):
        for k in range(count):
            rows.append((doc_id, source, " ".join(["w"] * (k % 13 + 1))))
            doc_id += 1
    return [*rows, (900, "big", ""), (901, "void", None)]


TARGETS = [
    mixing.Target(entropy=0.9, max_repeats=3.0, min_passes=0.0),
    mixing.Target(entropy=1.0, max_repeats=2.0, min_passes=1.0),
    mixing.Target(entropy=0.01, min_passes=0.0),
]


@pytest.mark.parametrize("target", TARGETS)
def test_copies_equal_those_of_a_plain_program(docs, compiled, target):
    rows = _rows()
    frame = docs([(d, text, "en", source) for d, source, text in rows])
    found, blocks = {}, set()
    for row in mixing.mix(frame, target).collect():
        found[row.doc_id] = found.get(row.doc_id, 0) + 1
        blocks.add(row.mix_block)
    with_tokens = {d for d, _, text in rows if text}
    expected = _brute(rows, target)
    assert {d: c for d, c in found.items() if d in with_tokens} == {
        d: c for d, c in expected.items() if d in with_tokens
    }
    assert min(blocks) >= 0 and max(blocks) < target.out_blocks
    if target.min_passes:
        assert with_tokens <= found.keys()


def test_every_block_holds_the_sources_at_their_weights(docs, compiled):
    rows = [(i, "w " * 5, "en", "a" if i % 4 else "b") for i in range(4000)]
    target = mixing.Target(entropy=1.0, max_repeats=4.0, min_passes=0.0, out_blocks=4)
    made = mixing.mix(docs(rows), target).groupBy("mix_block", "source").count().collect()
    counts = {(r.mix_block, r.source): r["count"] for r in made}
    for block in range(4):
        assert 0.4 < counts[block, "a"] / (counts[block, "a"] + counts[block, "b"]) < 0.6


def test_empty_tables_and_clashing_columns(docs, compiled):
    assert mixing.mix(docs([]), TARGETS[0]).count() == 0
    clash = docs(["a b", "c"]).withColumnRenamed("lang", "mix_pass")
    made = mixing.mix(clash, TARGETS[0])
    assert made.columns.count("mix_pass") == 1 and made.count() == 2


def test_tokens_of_scripts_without_spaces(docs, compiled, tmp_path):
    texts = {
        "": 0, "two words": 2, "naïve café": 2, "一个句子": 5, "日本語 text\nไทย": 9, "𠀀": 2, "한국어 말": 2,
    }
    frame = docs([*texts, None])
    made = frame.select("text", mixing.word_tokens().alias("n")).collect()
    assert {r.text: r.n for r in made} == texts | {None: 0}
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    sql = oracles.temperature_mix(queries.MIX_TARGET)
    connection = duckdb.connect()
    files = f"{tmp_path}/documents.parquet/*.parquet"
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{files}'")
    found = queries.temperature_mix(compiled, str(tmp_path))
    assert oracle_check.difference(found, connection, sql) is None
