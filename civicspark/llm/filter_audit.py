"""Interaction audit of quality filters by the potential of their removal game.

The players of the game are the filters; what a coalition of filters is worth is how many documents
it removes together.  Documents are folded to one count per part and set of filters they fail, so
the game is played on at most ``2 ** n`` numbers a part, whatever the size of the corpus."""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicspark.llm.frames import named

#: The filters of the audit, by letter; a document's failures are the bits of one number.
FILTERS = "ABCDE"
_WORD = r"[^\x20\x09-\x0D]+"
#: The filters that look at the text alone; the last one needs the other documents.
_OF_TEXT = 4
#: All orders of the filters are listed, so their number is bounded.
MOST_FILTERS = 6


def text_failures(text: Column) -> Column:
    """Bits of the filters that ``text`` alone decides: too few words (A), words that repeat (B),
    too many capitals (C), a sign of mark-up or code (D).  Null counts as empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(_WORD), F.lit(0))
    # The list of words is named once, inside the lambda, so that a text is split once.
    counts = F.transform(
        F.array(words),
        lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("differ")),
    )[0]
    capitals = F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))
    few = F.transform(
        F.array(counts),
        lambda c: (c["n"] < 200).cast("int")
        + 2 * (100 * c["differ"].cast("long") < 50 * c["n"].cast("long")).cast("int"),
    )[0]
    return (
        few
        + 4 * (100 * capitals.cast("long") > 3 * F.char_length(text).cast("long")).cast("int")
        + 8 * text.rlike("[#$%&*|]").cast("int")
    )


def marked(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents folded to ``part, failing, n, good, toxic``: how many fail just this set of filters,
    how many of them a label calls good, and toxic.

    A document fails the last filter if one with a smaller ``doc_id`` has the same text.  Copies
    fail the same other filters, so a text is known by its SHA-256 value from here on, copies are
    counted in the map tasks, and a text of which a third of all rows are copies is a few rows per
    task.  A row without ``doc_id`` is a copy of none and none is its copy; it has no labels.
    Several labels of a document count as one that holds all they say."""
    text = F.coalesce(named("text").cast("string"), F.lit(""))
    rows = documents.select(
        named("doc_id").alias("doc_id"),
        F.coalesce(named("lang").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("same"),
        text_failures(named("text")).alias("failing"),
    )
    said = (
        labels.select(
            named("doc_id").alias("doc_id"),
            (named("quality") == 1).alias("good"),
            (named("toxic") == 1).alias("toxic"),
        )
        .filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    )
    kinds = ["part", "failing", "good", "toxic"]
    known = rows.filter(F.col("doc_id").isNotNull()).join(said, "doc_id", "left")
    known = known.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    # One row per document (rows of equal id and text count up), then one per text and kind.
    by_id = known.groupBy("doc_id", "same", *kinds).agg(F.count("*").alias("n"))
    by_text = by_id.groupBy("same", *kinds).agg(
        F.sum("n").alias("n"),
        F.min("doc_id").alias("first"),
        F.min_by("n", "doc_id").alias("n_first"),
    )
    # A text has as many rows here as there are parts and labels.
    everywhere = F.min("first").over(Window.partitionBy("same"))
    originals = F.when(F.col("first") == everywhere, F.col("n_first")).otherwise(0)
    split = by_text.withColumn("originals", originals)
    copy = 1 << _OF_TEXT
    split = split.select(
        *kinds,
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("bit"), F.col("originals").alias("rows")),
                F.struct(F.lit(copy).alias("bit"), (F.col("n") - F.col("originals")).alias("rows")),
            )
        ),
    )
    split = split.select(
        "part", (F.col("failing") + F.col("bit")).alias("failing"), "good", "toxic", "rows"
    )
    nameless = rows.filter(F.col("doc_id").isNull()).select(
        "part", "failing", F.lit(False).alias("good"), F.lit(False).alias("toxic"),
        F.lit(1).cast("long").alias("rows"),
    )
    folded = split.unionByName(nameless).groupBy("part", "failing")
    counted = folded.agg(
        F.sum("rows").alias("n"),
        F.sum(F.when(F.col("good"), F.col("rows")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("rows")).otherwise(0)).alias("toxic"),
    )
    return counted.filter("n > 0")


def coalitions(counted: DataFrame, filters: int, tallies: Sequence[str]) -> DataFrame:
    """One row per part: for each tally the worth of all ``2 ** filters`` coalitions as an array
    (place = the coalition's bits), and under ``potential`` the scaled potentials of the first
    tally.

    ``counted`` holds one row per part and set of failed filters (``failing``).  A coalition is
    worth the documents that fail any of its filters.  The potential of Hart and Mas-Colell is
    ``P(S) = (worth(S) + sum of P(S without i)) / |S|``; kept here as ``|S|! P(S)``, it stays
    whole: ``Q(S) = (|S| - 1)! worth(S) + sum of Q(S without i)``.  Subsets have smaller bits, so
    one pass in the order of the bits meets them first."""
    every = F.sequence(F.lit(0), F.lit((1 << filters) - 1))
    entries = counted.groupBy("part").agg(
        F.collect_list(F.struct("failing", *tallies)).alias("entries")
    )

    def worth(tally: str) -> Column:
        def of(coalition: Column) -> Column:
            return F.aggregate(
                "entries",
                F.lit(0).cast("long"),
                lambda total, e: total
                + F.when(e["failing"].bitwiseAND(coalition) != 0, e[tally]).otherwise(0),
            )

        return F.transform(every, of)

    total = F.aggregate("entries", F.lit(0).cast("long"), lambda t, e: t + e[tallies[0]])
    worths = entries.select("part", total.alias("total"), *[worth(t).alias(t) for t in tallies])
    factorials = F.array(*[F.lit(math.factorial(max(k - 1, 0))) for k in range(filters + 1)])
    bits = F.array(*[F.lit(1 << k) for k in range(filters)])

    def next_potential(known: Column, coalition: Column) -> Column:
        size = F.bit_count(coalition)
        subsets = F.aggregate(
            bits,
            F.lit(0).cast("long"),
            lambda t, bit: t
            + F.when(
                coalition.bitwiseAND(bit) != 0, F.get(known, coalition - bit)
            ).otherwise(0),
        )
        own = F.get(factorials, size) * F.get(F.col(tallies[0]), coalition)
        return F.array_append(known, own + subsets)

    potential = F.aggregate(
        F.sequence(F.lit(1), F.lit((1 << filters) - 1)),
        F.array(F.lit(0).cast("long")),
        next_potential,
    )
    return worths.withColumn("potential", potential)


def audit(
    counted: DataFrame, filters: str = FILTERS, tallies: Sequence[str] = ("n", "good", "toxic")
) -> DataFrame:
    """What every filter does at every step of every order, per part.

    ``counted``: ``part, failing`` (bit k: the k-th filter fails) and whole-number ``tallies``, the
    first of which counts the documents.  Returns per part, ``filter_order`` and ``step``:

    - ``kept``, ``removed``: differences of what two coalitions are worth;
    - ``redundant``: documents that fail this filter and were gone; ``unique_fails``: fail no other;
    - ``<tally>_lost``: of each further tally, what this step removes;
    - ``shapley``: ``n!`` times the filter's Shapley value, that is the documents it removes, summed
      over all orders: the grand coalition's potential less that of the coalition without it.

    A part without documents has no rows; everything else has, zeros included."""
    n = len(filters)
    if not 1 <= n <= MOST_FILTERS or len(set(filters)) < n:
        raise ValueError(f"one to {MOST_FILTERS} different filters")
    games = coalitions(counted, n, tallies)
    grand = (1 << n) - 1
    steps = []
    for order in itertools.permutations(range(n)):
        name, before = "".join(filters[k] for k in order), 0
        for step, k in enumerate(order, start=1):
            steps.append((name, step, 1 << k, before))
            before |= 1 << k
    listed = F.from_json(
        F.lit(_json(steps)),
        "array<struct<filter_order: string, step: int, bit: int, before: int>>",
    )
    rows = games.select("*", F.inline(listed))
    bit, before = F.col("bit"), F.col("before")

    def lost(tally: str) -> Column:
        worth = F.col(tally)
        return F.get(worth, before.bitwiseOR(bit)) - F.get(worth, before)

    worth = F.col(tallies[0])
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.get(worth, before.bitwiseOR(bit))).alias("kept"),
        lost(tallies[0]).alias("removed"),
        (F.get(worth, bit) - lost(tallies[0])).alias("redundant"),
        (F.get(worth, F.lit(grand)) - F.get(worth, F.lit(grand) - bit)).alias("unique_fails"),
        *[lost(t).alias(f"{t}_lost") for t in tallies[1:]],
        (
            F.get("potential", F.lit(grand)) - n * F.get("potential", F.lit(grand) - bit)
        ).alias("shapley"),
    )


def _json(steps: list[tuple]) -> str:
    names = ("filter_order", "step", "bit", "before")
    return json.dumps([dict(zip(names, step, strict=True)) for step in steps])


def audited(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over ``documents`` (``doc_id, text, lang``; others are left
    alone), with ``labels`` (``doc_id, quality, toxic``).

    Null texts are empty, null languages the part ''; repeated rows count each; an empty table has
    no rows.  Very long texts are split into words whole, one at a time."""
    return audit(marked(documents, labels))
