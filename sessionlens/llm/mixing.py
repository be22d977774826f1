"""Mixing of sources by temperature, realised as budgeted block permutations.

The token share p of a source becomes the weight p**a, normalised. The exponent is
lowered from 1 (in proportion) towards 0 (all sources alike) until the entropy of the
weights reaches the target, but not so far that a source would be repeated more often
than allowed. The interval of the exponent is cut into `SECTIONS` parts at a time, each
time by one small aggregation over (source, exponent).

A source's budget of tokens is its weight times the whole budget. It is spent on whole
passes over the source and the beginning of one more. The documents of each pass are in
the order of a hash of (pass, doc_id). Where the last pass ends is found over `BLOCKS`
blocks of that order: sums per block, then a window inside the one block in which the
budget ends; no window spans a whole source. Each copy of a document finally gets the
block of the mixed corpus that its place in the source's permutations maps to, so that
every block holds the sources at their weights.

Defined cases: a null source is the source ''; a null text has no tokens; sources
without tokens have no weight and no copies; documents without tokens come where their
place is reached; equal rows are chosen or left together; an empty table stays empty; columns
of the input named mix_pass or mix_block give way, all others are kept.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.llm.staging import stage
from sessionlens.llm.texts import set_aside, text_or_empty

SECTIONS, ROUNDS = 32, 7
#: Blocks of a permutation for the search of its end, and of the mixed corpus.
BLOCKS = 4096
#: Places of a permutation are numbers below 2**60.
PLACE_BITS, BLOCK_BITS = 60, 12
#: Characters of scripts that put no spaces between words: Thai, Lao, Tibetan, Myanmar,
#: Khmer, Japanese and Chinese ones. Each counts as a token.
UNSPACED = (
    r"[\x{0E00}-\x{0FFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}"
    r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"
)
#: Columns that `mix` adds for a while.
_OWN = ("_source", "source_tokens", "budget", "passes", "rest", "cutoff", "_copies")


class Target(NamedTuple):
    """What the exponent is lowered for, and how much is taken.

    entropy: share of ln(number of sources). max_repeats: passes over a source at most.
    budget: tokens in all; None takes the fewest with which every source is passed over
    `min_passes` times. out_blocks: number of blocks of the mixed corpus.
    """

    entropy: float = 0.98
    max_repeats: float = 2.0
    budget: int | None = None
    min_passes: float = 1.0
    out_blocks: int = 256
    seed: str = "mix"


def word_tokens(text: str = "text") -> Column:
    """One more than the number of spaces and newlines, and every character of `UNSPACED`."""
    value = text_or_empty(text)
    gaps = F.length(value) - F.length(F.translate(value, " \n", ""))
    unspaced = F.length(value) - F.length(F.regexp_replace(value, UNSPACED + "+", ""))
    # Texts in ASCII need no search.
    unspaced = F.when(F.octet_length(value) > F.length(value), unspaced).otherwise(F.lit(0))
    return F.when(value == "", F.lit(0)).otherwise(gaps + 1 + unspaced).cast("long")


def _place(seed: str, number: Column) -> Column:
    """Place of a document in a pass, as a number below 2**60."""
    name = F.concat_ws(
        ":", F.lit(seed), number.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    )
    return F.conv(F.substring(F.md5(name), 1, PLACE_BITS // 4), 16, 10).cast("long")


def _source() -> Column:
    return F.coalesce(F.col("source"), F.lit(""))


def _weighed(shares: DataFrame, exponents: list[float]) -> DataFrame:
    rows = shares.withColumn("a", F.explode(F.array(*[F.lit(a) for a in exponents])))
    return rows.withColumn("w", F.pow("p", F.col("a")))


def _budget(target: Target) -> Column:
    """Budget at an exponent; z is the sum of the weights, r the least weight per token."""
    if target.budget is not None:
        return F.lit(float(target.budget))
    return target.min_passes * F.col("z") / F.col("r")


def exponent(shares: DataFrame, target: Target) -> float:
    """Least exponent of 0 to 1 at which neither target nor limit is exceeded.

    `shares` has one row (source, tokens, p) per source. If the target is reached at 1
    already, or the limit is, the exponent is 1.
    """
    n_sources = shares.count()
    wanted = target.entropy * math.log(max(n_sources, 1))
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [low + (high - low) * k / SECTIONS for k in range(SECTIONS + 1)]
        sums = (
            _weighed(shares, grid)
            .groupBy("a")
            .agg(
                F.sum("w").alias("z"),
                F.sum(F.col("w") * F.ln("w")).alias("e"),
                F.min(F.col("w") / F.col("tokens")).alias("r"),
                F.max(F.col("w") / F.col("tokens")).alias("most"),
            )
        )
        flat = (F.ln("z") - F.col("e") / F.col("z")) > wanted
        often = F.col("most") / F.col("z") * _budget(target) > target.max_repeats * (1 + 1e-12)
        beyond = sums.filter(flat | often).agg(F.max("a").alias("a")).first()["a"]
        if beyond is None:
            return low
        if beyond >= high:
            return high
        at = max(k for k, a in enumerate(grid) if a <= beyond)
        low, high = grid[at], grid[at + 1]
    return high


def _plan(shares: DataFrame, target: Target) -> DataFrame:
    """(source, tokens, budget, passes, rest) of every source with tokens."""
    weighed = _weighed(shares, [exponent(shares, target)])
    sums = weighed.groupBy("a").agg(
        F.sum("w").alias("z"), F.min(F.col("w") / F.col("tokens")).alias("r")
    )
    budget = F.round(F.col("w") / F.col("z") * _budget(target)).cast("long")
    rows = weighed.join(sums, "a").withColumn("budget", budget)
    return rows.select(
        "source",
        F.col("tokens").alias("source_tokens"),
        "budget",
        F.expr("budget div tokens").alias("passes"),
        (F.col("budget") % F.col("tokens")).alias("rest"),
    )


def _cutoffs(rows: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """(source, cutoff): the last place that the rest of each budget reaches."""
    placed = rows.join(plan, "source").filter(F.col("rest") > 0)
    placed = placed.select("source", "rest", "tokens", _place(seed, F.col("passes")).alias("place"))
    placed = placed.withColumn("block", F.shiftright("place", PLACE_BITS - BLOCK_BITS))
    per_block = placed.groupBy("source", "block", "rest").agg(F.sum("tokens").alias("t"))
    upto = F.sum("t").over(Window.partitionBy("source").orderBy("block"))
    per_block = per_block.withColumn("base", upto - F.col("t"))
    ends = per_block.filter(
        (F.col("base") <= F.col("rest")) & (F.col("base") + F.col("t") > F.col("rest"))
    ).select("source", "block", "base")
    inside = placed.join(ends, ["source", "block"])
    used = F.sum("tokens").over(Window.partitionBy("source", "block").orderBy("place"))
    reached = inside.withColumn("used", F.col("base") + used).filter(
        F.col("used") <= F.col("rest")
    )
    last = reached.groupBy("source").agg(F.max("place").alias("last"))
    before = F.shiftleft("block", PLACE_BITS - BLOCK_BITS) - 1
    return ends.join(last, "source", "left").select(
        "source", F.coalesce("last", before).alias("cutoff")
    )


def mix(docs: DataFrame, target: Target, tokens: Column | None = None) -> DataFrame:
    """A row for every copy of a document: `docs` with mix_pass and mix_block."""
    tokens = word_tokens() if tokens is None else tokens
    counted = docs.select("doc_id", _source().alias("source"), tokens.alias("tokens"))
    docs, back = set_aside(docs, _OWN)
    rows = stage(counted, "mix")
    totals = rows.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    totals = totals.filter(F.col("tokens") > 0)
    total = totals.agg(F.sum("tokens")).first()[0] or 1
    share = F.col("tokens") / F.lit(float(total))
    shares = stage(totals.withColumn("p", share), "mix-shares")
    if target.budget is None and target.min_passes <= 0:
        target = target._replace(budget=int(total))
    plan = stage(_plan(shares, target), "mix-plan")
    cutoffs = _cutoffs(rows, plan, target.seed)
    plan = stage(plan.join(cutoffs, "source", "left"), "mix-cutoffs")
    plan = plan.withColumnRenamed("source", "_source")
    made = ("mix_pass", "mix_block")
    names = [c for c in docs.columns if c not in made]
    planned = docs.select(*names).join(plan, _source() == F.col("_source"))
    extra = (F.col("rest") > 0) & (
        _place(target.seed, F.col("passes")) <= F.coalesce("cutoff", F.lit(-1).cast("long"))
    )
    copies = (F.col("passes") + extra.cast("long")).cast("int")
    repeated = planned.withColumn("_copies", copies).filter(F.col("_copies") > 0)
    repeated = repeated.withColumn(
        "mix_pass", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))
    )
    # The stream of a source is as long as its budget, in passes.
    along = F.col("mix_pass") + _place(target.seed, F.col("mix_pass")) / F.lit(float(2**PLACE_BITS))
    position = along * F.col("source_tokens") / F.col("budget")
    block = F.least(F.floor(position * target.out_blocks), F.lit(target.out_blocks - 1))
    made_rows = repeated.select(*names, "mix_pass", block.cast("int").alias("mix_block"))
    return made_rows.withColumnsRenamed(back)
