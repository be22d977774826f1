"""URL filter: rules for hosts and paths, and a weighted vocabulary for the rest.

Rules come first: the longest rule that fits decides. An address that no rule fits is
judged by its vocabulary: an Aho-Corasick automaton finds all terms of the lower-cased
address in one pass; a find counts where neither neighbour is a letter or digit. One
strict term, or several distinct soft terms, reject it.

Defined cases: a null address has an empty host and path, fits no rule and is allowed;
terms that overlap or repeat count once each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionlens.llm.texts import with_batch_columns

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


class Vocabulary(NamedTuple):
    """Terms in lower case. `soft_limit` distinct soft terms reject an address."""

    strict: Sequence[str]
    soft: Sequence[str]
    soft_limit: int = 2


STRICT_TERMS = (
    "bestiality", "bondage", "camgirl", "camgirls", "casino", "escort", "escorts", "gangbang",
    "hardcore-sex", "hentai", "milf", "nude", "nudes", "porn", "porno", "pornhub", "sexcam",
    "sexchat", "viagra", "warez", "webcamsex", "xxx",
)
SOFT_TERMS = (
    "adult", "bet", "betting", "bingo", "bonus", "cheap", "cialis", "crack", "deal", "deals",
    "discount", "download", "drugs", "erotic", "free", "gamble", "gambling", "jackpot", "keygen",
    "loan", "loans", "lottery", "money", "pharmacy", "pill", "pills", "poker", "prize", "replica",
    "sex", "sexy", "slots", "spam", "torrent", "win", "winner",
)
DEFAULT_VOCABULARY = Vocabulary(STRICT_TERMS, SOFT_TERMS)


def host(url: str = "url") -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end; A-Z in lower case."""
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(found, upper, upper.lower())


def path(url: str = "url") -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    address = F.coalesce(F.col(url), F.lit(""))
    return F.regexp_extract(address, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(rules: Sequence[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else null.

    A rule fits its host and all subdomains, where the path starts with the rule's.
    """
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        own = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits = own & F.startswith(path, F.lit(rule.path))
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def _automaton(vocabulary: Vocabulary) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for kind, terms in (("soft", vocabulary.soft), ("strict", vocabulary.strict)):
        for term in terms:
            automaton.add_word(term, (kind, term))
    automaton.make_automaton()
    return automaton


def _finds(automaton: ahocorasick.Automaton, address: str) -> Iterator[tuple[str, str]]:
    for end, (kind, term) in automaton.iter(address):
        start = end - len(term) + 1
        before = address[start - 1] if start else ""
        after = address[end + 1:end + 2]
        if not before.isalnum() and not after.isalnum():
            yield kind, term


def with_term_counts(
    pages: DataFrame, vocabulary: Vocabulary = DEFAULT_VOCABULARY, url: str = "url"
) -> DataFrame:
    """`pages` with the numbers of distinct strict and soft terms in each address."""
    fields = [T.StructField(name, T.IntegerType(), False) for name in ("n_strict", "n_soft")]

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        automaton = _automaton(vocabulary)
        strict, soft = [], []
        for address in batch.column(batch.schema.get_field_index(url)).to_pylist():
            found = set(_finds(automaton, (address or "").lower()))
            strict.append(sum(kind == "strict" for kind, _ in found))
            soft.append(len(found) - strict[-1])
        return {"n_strict": pa.array(strict, pa.int32()), "n_soft": pa.array(soft, pa.int32())}

    return with_batch_columns(pages, compute, fields)


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    vocabulary: Vocabulary = DEFAULT_VOCABULARY,
    url: str = "url",
) -> DataFrame:
    """`pages` with host, path, rule, n_strict, n_soft and verdict."""
    counted = with_term_counts(pages, vocabulary, url)
    # Columns of the input with these names give way.
    counted = counted.withColumns({"host": host(url), "path": path(url)})
    rule, by_rule = longest_rule(rules, F.col("host"), F.col("path"))
    rejected = (F.col("n_strict") > 0) | (F.col("n_soft") >= vocabulary.soft_limit)
    by_terms = F.when(rejected, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return counted.withColumns({"rule": rule, "verdict": F.coalesce(by_rule, by_terms)})
