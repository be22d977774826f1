"""Document fingerprints by I-Match, in SQL functions only.

A term is a run of letters and digits in lower case. The lexicon holds the terms whose
share of documents lies in a band, that is, whose inverse document frequency does; it
is counted over all documents. As every term of the lexicon lies in at least
`least_share` of the documents, it has at most (mean number of distinct terms of a
document) / `least_share` terms, however many documents there are: a size bound under
which it is broadcast.

Randomised subsets of the lexicon keep a term by a hash of the term: `SUBSETS` of them,
of falling density, so that long and short texts have terms in some. Of each subset a
text's sorted distinct terms are hashed; the fingerprint is the list of these hashes, or
of dots where a text has no term of the subset. Two fingerprints are alike by the share
of subsets with an equal hash among those in which either has terms.

Defined cases: a null text is empty; equal texts have equal fingerprints; two texts
without any term of the lexicon are alike (1.0); repeated rows are documents of their
own, in the order of doc_id and text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionlens.llm.staging import stage
from sessionlens.llm.texts import text_or_empty

#: Shares of documents between which a term must lie to be in the lexicon.
LEAST_SHARE, MOST_SHARE = 0.002, 0.25
#: Each density 1/2 ... 1/256 has this many subsets.
DENSITIES, SUBSETS_EACH = 8, 4
SUBSETS = DENSITIES * SUBSETS_EACH
HASH_CHARS = 8
_EMPTY = "." * HASH_CHARS
#: Of each density: the bits of its subsets.
_BITS = [sum(1 << (d + DENSITIES * i) for i in range(SUBSETS_EACH)) for d in range(DENSITIES)]
#: About so many documents are brought together to find each one's successor.
BLOCK_ROWS = 1024
_NO_TERM = r"[^\p{L}\p{N}]+"


def _subset_numbers() -> Column:
    return F.sequence(F.lit(0), F.lit(SUBSETS - 1))


def terms(text: Column) -> Column:
    """Distinct terms of a text."""
    return F.array_remove(F.array_distinct(F.split(F.lower(text), _NO_TERM)), "")


def lexicon(
    docs: DataFrame, least_share: float = LEAST_SHARE, most_share: float = MOST_SHARE
) -> DataFrame:
    """Terms in the band, each with the subsets that keep it as a bit mask."""
    n_docs = docs.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    counted = (
        # An inner explode would add a filter that computes the terms once more.
        docs.select(F.explode_outer(terms(text_or_empty())).alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
        .filter(F.col("df").between(math.ceil(least_share * n_docs), most_share * n_docs))
    )
    return counted.select("term", _subset_mask(F.col("term")).alias("mask"))


def _subset_mask(term: Column) -> Column:
    """Bit k: whether subset k keeps the term; two hex digits of a hash decide."""

    def bit(k: Column) -> Column:
        digest = F.md5(F.concat(F.floor(k / DENSITIES).cast("string"), F.lit(":"), term))
        density = k % DENSITIES
        digits = F.conv(F.substr(digest, 1 + 2 * density, F.lit(2)), 16, 10).cast("int")
        kept = digits < F.pow(F.lit(2), DENSITIES - 1 - density)
        return F.when(kept, F.pow(F.lit(2), k).cast("long")).otherwise(F.lit(0).cast("long"))

    return F.aggregate(_subset_numbers(), F.lit(0).cast("long"), lambda mask, k: mask + bit(k))


def _hashes(kept: Column) -> Column:
    """The hash of each subset, of an array of (term, mask), sorted by term and without repeats.

    A lambda computes what it names as often as it names it, so each step is an array of its
    own. A term lies in four subsets on the average: those of a density look only at the terms
    that lie in one of them.
    """

    def of_density(bits: Column) -> Column:
        return F.filter(kept, lambda x: x["mask"].bitwiseAND(bits) != 0)

    def joined(k: Column, by_density: Column) -> Column:
        chosen = F.filter(
            by_density[k % DENSITIES], lambda x: F.getbit(x["mask"], k).cast("boolean")
        )
        return F.array_join(chosen["term"], " ")

    def digest(text: Column) -> Column:
        # No text of a term is empty, so an empty join means an empty choice.
        found = F.substring(F.md5(text), 1, HASH_CHARS)
        return F.when(text == "", F.lit(_EMPTY)).otherwise(found)

    densities = F.transform(F.array(*[F.lit(b).cast("long") for b in _BITS]), of_density)
    texts = F.transform(
        F.array(densities),
        lambda by_density: F.transform(_subset_numbers(), lambda k: joined(k, by_density)),
    )[0]
    return F.transform(texts, digest)


def _equalities(left: Column, right: Column) -> Column:
    """Of two arrays of hashes: whether they are equal, for the subsets in which either text
    has terms."""

    def equal(a: Column, b: Column) -> Column:
        return F.when((a != _EMPTY) | (b != _EMPTY), a == b)

    return F.array_compact(F.zip_with(left, right, equal))


def _share(equalities: Column) -> Column:
    """Share of those that are true; two texts without terms are alike."""
    equal = F.size(F.array_remove(equalities, False)).cast("double")
    return F.when(F.size(equalities) == 0, F.lit(1.0)).otherwise(equal / F.size(equalities))


def _blocks(docs: DataFrame) -> DataFrame:
    """Whole documents with `block`, a number that does not fall with the id.

    Each block also gets, as a guest, the first document of the next one (the last
    block that of the first), so that every document finds its successor in its block.
    """
    ids = docs.agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n")
    ).first()
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    block = F.lit(0).cast("long")
    if ids["least"] is not None:
        count = ids["n"] // BLOCK_ROWS + 1
        spread = F.lit(count / (ids["most"] - ids["least"] + 1))
        # The distance of two ids may be twice as wide as an id.
        wide = "decimal(20,0)"
        distance = F.col("doc_id").cast(wide) - F.lit(str(ids["least"])).cast(wide)
        place = F.floor(distance.cast("double") * spread).cast("long")
        block = F.coalesce(place, F.lit(-1).cast("long"))
    rows = rows.withColumn("block", block)
    # Null ids sort first, as a block of their own.
    known = rows.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy("block")
    previous = known.select(
        F.col("block").alias("own"), F.lag("block").over(order).alias("before")
    )
    last = known.agg(F.max("block").alias("last"))
    previous = previous.join(F.broadcast(last)).select(
        F.col("own").alias("block"), F.coalesce("before", "last").alias("host")
    )
    first = F.min(F.struct(F.col("doc_id"), F.col("text"))).alias("first")
    guests = (
        rows.groupBy("block")
        .agg(first)
        .join(previous, "block")
        .select("first.doc_id", "first.text", F.col("host").alias("block"))
    )
    return rows.withColumn("guest", F.lit(0)).unionByName(
        guests.withColumn("guest", F.lit(1))
    )


def fingerprints(
    docs: DataFrame, least_share: float = LEAST_SHARE, most_share: float = MOST_SHARE
) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and how alike they are.

    The edited text has the last half of the document replaced by the beginning of the
    next one. Texts are shuffled once, by block; the terms are looked up in the
    broadcast lexicon and brought together again inside the same partitions.
    """
    words = F.broadcast(stage(lexicon(docs, least_share, most_share), "imatch-lexicon"))
    in_block = Window.partitionBy("block").orderBy("guest", "doc_id", "text")
    half = F.floor(F.length("text") / 2).cast("int")
    pairs = (
        _blocks(docs)
        .withColumn("place", F.row_number().over(in_block))
        .withColumn("next_text", F.coalesce(F.lead("text").over(in_block), F.lit("")))
        .withColumn(
            "edited",
            F.concat(
                F.substr("text", F.lit(1), F.length("text") - half),
                F.substr("next_text", F.lit(1), half),
            ),
        )
    )
    marker = F.array(F.lit(""))  # keeps documents without a term of the lexicon

    def side(number: int, text: str) -> Column:
        all_terms = F.concat(marker, terms(F.col(text)))
        return F.struct(F.lit(number).alias("side"), all_terms.alias("terms"))

    sides = pairs.select(
        "block",
        "place",
        "guest",
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.explode(F.array(side(0, "text"), side(1, "edited"))).alias("s"),
    )
    exploded = sides.select(
        "block", "place", "guest", F.col("s.side").alias("side"),
        F.explode_outer("s.terms").alias("term"), "doc_id", "n_chars", "edited_sha256",
    )
    found = exploded.join(words, "term", "left").filter(
        F.col("mask").isNotNull() | (F.col("term") == "")
    )
    entry = F.struct("term", "mask")
    is_marker = F.col("term") == ""
    # What belongs to the document goes with its markers alone, so that the rows stay narrow.
    about = F.when(is_marker, F.struct("doc_id", "n_chars", "edited_sha256"))

    def of_side(number: int) -> Column:
        return ~is_marker & (F.col("side") == number)

    gathered = (
        found.select("block", "place", "guest", "side", "term", "mask", about.alias("about"))
        .groupBy("block", "place", "guest")
        .agg(
            F.max("about").alias("about"),
            # The terms of a text are distinct, and so are those of the lexicon.
            F.sort_array(F.collect_list(F.when(of_side(0), entry))).alias("own"),
            F.sort_array(F.collect_list(F.when(of_side(1), entry))).alias("other"),
        )
        .select("block", "place", "guest", "about.*", "own", "other")
    )
    by_place = Window.partitionBy("block").orderBy("place")
    hashed = gathered.select(
        "block", "place", "guest", "doc_id", "n_chars", "edited_sha256",
        _hashes(F.col("own")).alias("hashes"),
        _hashes(F.col("other")).alias("edited_hashes"),
    ).withColumn("next_hashes", F.lead("hashes").over(by_place))
    compared = hashed.filter(F.col("guest") == 0).withColumns(
        {
            "edited_equal": _equalities(F.col("hashes"), F.col("edited_hashes")),
            "next_equal": _equalities(F.col("hashes"), F.col("next_hashes")),
        }
    )
    return compared.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.array_join("hashes", "").alias("fingerprint"),
        F.array_join("edited_hashes", "").alias("edited_fingerprint"),
        _share(F.col("edited_equal")).alias("near_edited"),
        _share(F.col("next_equal")).alias("near_next"),
    )
