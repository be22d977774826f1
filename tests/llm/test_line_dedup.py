"""Chunk dedup against a plain program over the same chunks."""

import hashlib
import random

from sessionlens.llm import line_dedup as d


def _lines(text):
    for separator in d.SEPARATORS:
        text = text.replace(separator, separator + "\0")
    return [line for line in text.split("\0") if line]


def _chunks(text):
    lines = _lines(text or "")
    hashes = [int(hashlib.md5(line.encode()).hexdigest()[:8], 16) for line in lines]
    rolled = [
        ((hashes[i - 1] if i else 0) * d.FACTOR + h) % d.HASH_RANGE for i, h in enumerate(hashes)
    ]
    chunks, start = [], 0
    for i in range(len(lines)):
        inner = 0 < i < len(lines) - 1 and rolled[i] < rolled[i - 1] and rolled[i] < rolled[i + 1]
        if inner or i == len(lines) - 1 or i + 1 - start == d.MOST_LINES:
            chunks.append((i + 1 - start, "".join(lines[start:i + 1])))
            start = i + 1
    return chunks


def _brute(rows):
    seen, found = set(), []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        chunks, kept, gone = _chunks(text), [], 0
        for n, chunk in chunks:
            long_enough = n >= d.LEAST_LINES and len(chunk) >= d.LEAST_CHARS
            if long_enough and chunk in seen:
                gone += 1
            else:
                kept.append(chunk)
            if long_enough:
                seen.add(chunk)
        found.append((doc_id, text if text is None else "".join(kept), len(chunks), gone))
    return found


def _rows():
    dice = random.Random(2)
    word = lambda: "".join(dice.choices("abcdef", k=5))
    line = lambda: " ".join(word() for _ in range(dice.randrange(2, 9)))
    passage = "".join(line() + dice.choice([". ", ", ", "\n"]) for _ in range(14))
    rows = [None, "", "\n", "one line", "a. b, c\n\n", "x \x01 y. z"]
    for _ in range(25):
        text = "".join(line() + dice.choice([". ", ", ", "\n"]) for _ in range(dice.randrange(1, 30)))
        cut = dice.randrange(len(text) + 1)
        rows += [text[:cut] + passage + text[cut:], text]
    rows += [rows[-1], rows[-2], "same line here. " * 300]
    return list(enumerate(rows)), passage


def _found(frame):
    return [
        (r.doc_id, r.text, r.n_chunks, r.n_removed) for r in frame.orderBy("doc_id").collect()
    ]


def test_dedup_equals_plain_program(docs, compiled):
    rows, passage = _rows()
    found = _found(d.deduplicate(docs([(i, t, "en", "a") for i, t in rows])))
    expected = _brute([r for r in rows if "\x01" not in (r[1] or "")])
    assert [r for r in found if r[0] != 5] == expected
    # Text without copies stays, marks of the splitter included.
    assert found[5][1] == rows[5][1]
    # The passage is whole in the document in which it comes first, and nowhere else.
    assert sum(passage in (text or "") for _, text, _, _ in found) == 1


def test_runs_of_equal_lines(docs, compiled):
    line = "all of these lines are the same one\n"
    texts = [line * 50, "Before that. " + line * 60, line * 50, "A start. " * 3 + line * 7]
    found = _found(d.deduplicate(docs(texts)))
    assert found == _brute(list(enumerate(texts)))
    kept = [text.count("same") for _, text, _, _ in found]
    assert kept[0] < 50 and kept[1] < 60 and kept[2] == 0


def test_lines_join_to_the_text_and_columns_are_kept(docs, compiled):
    frame = docs(["a. b, c\nd", "x\x01y. z"]).withColumnRenamed("lang", "n_removed")
    made = d.deduplicate(frame)
    assert set(made.columns) == {*frame.columns, "n_chunks", "n_removed"}
    assert [r.text for r in made.orderBy("doc_id").collect()] == ["a. b, c\nd", "x\x01y. z"]
    assert d.deduplicate(docs([])).count() == 0


def test_no_python_in_the_plan(docs):
    plan = d.deduplicate(docs(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
