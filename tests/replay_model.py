"""An independent, sequential model of the replay of one session."""

from __future__ import annotations

from collections import Counter

FIELDS = (
    "event_ts",
    "event_type",
    "detail_name",
    "model",
    "input_tokens",
    "output_tokens",
    "cost_usd",
    "error_category",
    "content_preview",
    "duration_ms",
)


def in_order(rows):
    """Sorted by all fields, missing values first."""
    return sorted(rows, key=lambda r: [(r.get(f) is not None, r.get(f)) for f in FIELDS])


def interactions(rows):
    groups = []
    for row in in_order(rows):
        if not groups or row["event_type"] == "USER_PROMPT":
            groups.append([])
        groups[-1].append(row)
    return groups


def line(row):
    tokens = f"{row.get('input_tokens') or 0}/{row.get('output_tokens') or 0}"
    return (
        f"{row.get('event_ts')} [{row.get('event_type')}] {row.get('detail_name')} "
        f"model={row.get('model')} tokens={tokens} cost=${row.get('cost_usd') or 0:.4f} "
        f"err={row.get('error_category') or ''} | {(row.get('content_preview') or '')[:200]}"
    )


def summary(group):
    kinds = Counter(row["event_type"] for row in group)
    types = " ".join(f"{kind}={count}" for kind, count in kinds.most_common())
    cost = round(sum(row.get("cost_usd") or 0 for row in group), 9)
    duration = round(sum(row.get("duration_ms") or 0 for row in group), 6) or 0
    return (
        f"--- [compressed: {len(group)} events, types: {types}, "
        f"cost=${cost:.4f}, duration={duration}ms] ---"
    )


def replay(rows, keep=2, budget=30_000):
    groups = interactions(rows)
    lines = []
    for number, group in enumerate(groups):
        if len(groups) <= 2 * keep or number < keep or number >= len(groups) - keep:
            lines += [line(row) for row in group]
        else:
            lines.append(summary(group))
    return "\n".join(lines)[:budget]
