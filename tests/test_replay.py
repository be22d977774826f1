import random
from collections import Counter
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import replay_model as model
from conftest import at, event, events
from sessionlens import vocabulary as v
from sessionlens.operators import ordering, replay


def _random_rows(seed, sessions=6, count=300, prompts=0.3):
    """Events with ties, copies, missing fields and missing timestamps."""
    generator = random.Random(seed)
    rows = []
    for _ in range(count):
        prompt = generator.random() < prompts
        kind = v.USER_PROMPT if prompt else generator.choice(
            [v.LLM_CALL, v.TOOL_CALL, v.TOOL_RESULT, v.USER_ABORTED, "ZZ_LATER"]
        )
        rows.append(
            event(
                kind,
                None if generator.random() < 0.05 else generator.randint(0, 300) / 2,
                f"s{generator.randint(0, sessions - 1)}",
                detail_name=generator.choice(["run", "", None]),
                model=generator.choice(["m1", None]),
                input_tokens=generator.choice([7, None]),
                output_tokens=generator.choice([3, 0, None]),
                cost_usd=generator.choice([0.00015, 0.25, None]),
                error_category=generator.choice(["user_visible", None, None]),
                content_preview=generator.choice(["p" * 300 + "a", "p" * 300 + "b", "short", None]),
                duration_ms=generator.choice([1.5, 20.0, None]),
            )
        )
        if generator.random() < 0.1:
            rows += [dict(rows[-1])] * generator.randint(1, 3)
    return rows


def _by_session(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row["session_id"], []).append(row)
    return groups


def _replays(spark, rows, **options):
    found = replay.session_replay(events(spark, rows), **options).collect()
    texts = {row.session_id: row.replay_text for row in found}
    assert len(texts) == len(found)
    return texts


@pytest.mark.parametrize(
    "seed, options",
    [
        (1, {}),
        (2, {"keep": 1}),
        (3, {"keep": 3, "bucket_s": 5}),
        (4, {"budget": 1500}),
        (5, {"keep": 1, "budget": 333, "bucket_s": 100_000}),
    ],
)
def test_replay_equals_the_sequential_model(spark, seed, options):
    rows = _random_rows(seed)
    plain = {key: value for key, value in options.items() if key != "bucket_s"}
    expected = {name: model.replay(own, **plain) for name, own in _by_session(rows).items()}
    assert _replays(spark, rows, **options) == expected


@pytest.mark.parametrize("seed, prompts", [(6, 0.0), (7, 1.0), (8, 0.02)])
def test_replay_of_extreme_sessions(spark, seed, prompts):
    rows = _random_rows(seed, sessions=3, count=120, prompts=prompts)
    expected = {name: model.replay(own) for name, own in _by_session(rows).items()}
    assert _replays(spark, rows) == expected


def test_many_copies_of_one_prompt_and_of_one_event(spark):
    rows = [event(v.USER_PROMPT, 5, content_preview="again", duration_ms=2.0)] * 900
    rows += [event(v.LLM_CALL, 7, model="m", cost_usd=0.1)] * 900
    rows += [event(v.TOOL_CALL, 1)] * 3
    assert _replays(spark, rows) == {"s1": model.replay(rows)}
    assert _replays(spark, rows, budget=90_000) == {"s1": model.replay(rows, budget=90_000)}


def test_a_long_session_stays_in_budget(spark):
    rows = [
        event(v.USER_PROMPT if i % 7 == 0 else v.LLM_CALL, i, content_preview=f"e{i} " * 20)
        for i in range(6000)
    ]
    text = _replays(spark, rows)["s1"]
    assert len(text) == v.REPLAY_CHAR_BUDGET
    assert text == model.replay(rows)


def test_fractions_of_seconds_are_printed(spark):
    rows = [event(v.LLM_CALL, 0.25), event(v.LLM_CALL, 1)]
    assert _replays(spark, rows) == {"s1": model.replay(rows)}


def test_shortest_line_is_no_longer_than_any_line(spark):
    nothing = event("", None, detail_name="", model="")
    line = events(spark, [nothing]).select(replay.event_line().alias("line")).first().line
    assert len(line) + 1 == replay.SHORTEST_LINE
    compressed = model.summary([{"event_type": ""}])
    assert len(compressed) + 1 >= replay.SHORTEST_LINE


@pytest.mark.parametrize("bucket_s", [1, 60, 100_000])
def test_interaction_index_of_every_event(spark, bucket_s):
    rows = _random_rows(9)
    indexed = replay.with_interaction_index(events(spark, rows), bucket_s).collect()
    found = Counter(
        (r.session_id, r.interaction_index, *[r[f] for f in model.FIELDS]) for r in indexed
    )
    expected = Counter(
        (name, number, *[row.get(f) for f in model.FIELDS])
        for name, own in _by_session(rows).items()
        for number, group in enumerate(model.interactions(own))
        for row in group
    )
    assert found == expected


def test_compressed_lines_of_all_interactions(spark):
    rows = _random_rows(10)
    found = replay.compressed_interactions(events(spark, rows)).collect()
    lines = {(r.session_id, r.interaction_index): (r.num_events, r.line) for r in found}
    assert lines == {
        (name, number): (len(group), model.summary(group))
        for name, own in _by_session(rows).items()
        for number, group in enumerate(model.interactions(own))
    }


def test_offsets_know_a_prefix_without_prompt(spark):
    rows = [
        event(v.LLM_CALL, 1, "prefix"),
        event(v.USER_PROMPT, 2, "prefix"),
        event(v.USER_PROMPT, 1, "none"),
        event("ZZ_LATER", 1, "none"),
        event(v.LLM_CALL, 1, "silent"),
    ]
    offsets = ordering.leaf_offsets(events(spark, rows)).collect()
    assert {r.session_id: (r.has_prefix, r.num_interactions) for r in offsets} == {
        "prefix": (1, 2),
        "none": (0, 1),
        "silent": (1, 1),
    }


def test_sessions_without_events_have_no_replay(spark):
    assert _replays(spark, []) == {}
    with pytest.raises(ValueError):
        replay.session_replay(events(spark, []), keep=0)


def test_a_long_tail_is_held_back_before_the_shuffle(spark):
    """Only about as many tail lines as fit are rendered, whatever the budget."""
    rows = [event(v.USER_PROMPT, 100 * i) for i in range(5)]
    rows += [event(v.LLM_CALL, 400 + i, detail_name=f"n{i}") for i in range(3000)]
    table = events(spark, rows)
    placed = replay._placed_slots(table, 60, keep=2)
    lines = replay.lines_within(2000)
    parts = placed.select("*", F.inline(replay._parts(2, lines))).filter("low <= high")
    tail = parts.filter("part = 2").agg(F.sum(F.col("high") - F.col("low") + 1)).first()[0]
    assert tail <= 60 + 100 + lines
    for budget in (2000, 60_000):
        text = replay.session_replay(table, budget=budget).first().replay_text
        assert text == replay.session_replay(table, budget=10**6).first().replay_text[:budget]


def _crowded(kind):
    """A session with 100,000 events in one minute, or as many without time."""
    rows = []
    for i in range(100_000):
        ts = None if kind == "timeless" else 60 + (i % 60_000) / 1000 + (i // 60_000) / 3000
        name = v.USER_PROMPT if i % 25_000 == 0 else (v.LLM_CALL, v.TOOL_CALL)[i % 2]
        rows.append(("s1", ts, name, f"n{i % 977}", float(i % 3)))
    return rows


@pytest.fixture(scope="module", params=["one minute", "timeless"])
def crowd(request, spark):
    plain = _crowded(request.param)
    frame = spark.createDataFrame(plain, "session_id string, s double, event_type string, "
                                  "detail_name string, duration_ms double")
    start = F.lit(at(0).isoformat()).cast("timestamp")
    made = frame.withColumn("event_ts", F.timestamp_micros(
        F.unix_micros(start) + F.round(F.col("s") * 1_000_000).cast("long")))
    others = ("model string", "input_tokens long", "output_tokens long", "cost_usd double",
              "error_category string", "content_preview string")
    for name, kind in map(str.split, others):
        made = made.withColumn(name, F.lit(None).cast(kind))
    rows = [
        event(kind, None if s is None else s, detail_name=name, duration_ms=ms)
        for _, s, kind, name, ms in plain
    ]
    if request.param == "one minute":
        for row, (_, s, *_rest) in zip(rows, plain):
            row["event_ts"] = at(0).replace(microsecond=0) + timedelta(microseconds=round(s * 1e6))
    return made, rows


def test_no_window_group_of_a_crowded_session_is_large(spark, crowd):
    frame, _ = crowd
    offsets = ordering.leaf_offsets(frame)
    slots = ordering.in_leaves(replay._slots(frame, ordering.BUCKET_S), offsets)
    for groups in (
        slots.groupBy("session_id", "b", "leaf"),
        ordering._cells(frame, ordering.BUCKET_S).groupBy("session_id", "b"),
        offsets.groupBy("session_id"),
    ):
        assert groups.count().agg(F.max("count")).first()[0] < 10_000


def test_replay_of_a_crowded_session(spark, crowd):
    frame, rows = crowd
    assert replay.session_replay(frame).first().replay_text == model.replay(rows)


def test_index_of_a_crowded_session(spark, crowd):
    frame, rows = crowd
    found = replay.with_interaction_index(frame).groupBy("interaction_index").count().collect()
    sizes = {r.interaction_index: r["count"] for r in found}
    assert sizes == {i: len(group) for i, group in enumerate(model.interactions(rows))}


@pytest.mark.parametrize("most", [1, 4])
def test_small_leaves_change_nothing(spark, most):
    rows = _random_rows(11, sessions=3, count=150)
    table = events(spark, rows)
    texts = {r.session_id: r.replay_text for r in replay.replay_lines(table, most=most)
             .groupBy("session_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(
                 F.struct("part", "position", "line"))), lambda x: x["line"]), "\n")
                 .alias("replay_text")).collect()}
    expected = {name: model.replay(own) for name, own in _by_session(rows).items()}
    assert {name: text[:v.REPLAY_CHAR_BUDGET] for name, text in texts.items()} == expected
    lines = replay.compressed_interactions(table, most=most).collect()
    assert {(r.session_id, r.interaction_index): r.line for r in lines} == {
        (name, number): model.summary(group)
        for name, own in _by_session(rows).items()
        for number, group in enumerate(model.interactions(own))
    }
