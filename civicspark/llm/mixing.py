"""Mixing sources to target weights by Pfair scheduling.

Rows of a source are put in random but repeatable order and cut into blocks.  If all sources gave
their rows evenly, in proportion to their weights, source i with weight a(i) would give its block
m between the times m / a(i) and (m + 1) / a(i).  In slots (blocks given by all sources together)
these are its release time, rounded down, and its deadline, rounded up.  At every slot the block
with the earliest deadline among those released comes next.  All deadlines can be met, as the even
shares show, so at every slot each source has given its share to within less than one block.

With P = a(1) + a(2) + ... the pattern repeats every P slots, so one cycle is scheduled for each set
of shares: all sources, and again whenever a source gives its last blocks or has ended.  A source
that ends leaves its slots to the others, in proportion to their weights; no row is dropped or
repeated.

Everything is DataFrame functions.  Rows are numbered within (source, hash range), ranges of bounded
size whose totals are summed up first, so that a source with any share of the rows is spread over
the cluster.  What is joined to the rows is one line a source.

Weights are positive whole numbers, slots per cycle.  Without given weights a source gets slots in
proportion to the square root of its rows, one at least.  Defined results: null is a source like
others; rows that are equal in id get neighbouring places in either order; an empty table gives no
rows; given weights must name every source, or ``other`` must be positive."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from civicspark.llm.frames import cut, fresh, named

#: Rows of a block.
BLOCK_ROWS = 32
#: Slots that the sources share in a cycle when weights are not given, about.
CYCLE = 512
#: Rows of all sources in one hash range.
RANGE_ROWS = 50_000


def _quota(cycle: Column) -> Column:
    """Blocks that each source gives in the cycle, as an array in order of the sources."""
    return F.transform(
        "sources",
        lambda s: F.when(cycle < F.floor(s["blocks"] / s["weight"]), s["weight"])
        .when(cycle == F.floor(s["blocks"] / s["weight"]), s["blocks"] % s["weight"])
        .otherwise(F.lit(0).cast("long")),
    )


def _windows() -> Column:
    """For a row with ``sources`` and ``quota``: release and deadline of each source's blocks."""

    def slot(of: Column, m: Column) -> Column:
        """Slots, times the weight of ``of``, that all sources fill until it has given m blocks."""
        return F.aggregate(
            F.zip_with("sources", "quota", lambda s, q: F.least(q * of["weight"], s["weight"] * m)),
            F.lit(0).cast("long"),
            lambda n, x: n + x,
        )

    def windows(of: Column, quota: Column) -> Column:
        blocks = F.when(quota > 0, F.sequence(F.lit(0).cast("long"), quota - 1)).otherwise(
            F.array().cast("array<long>")
        )
        return F.transform(
            blocks,
            lambda m: F.struct(
                F.floor(slot(of, m) / of["weight"]).alias("release"),
                F.ceil(slot(of, m + 1) / of["weight"]).alias("by"),
            ),
        )

    return F.zip_with("sources", "quota", windows)


def _earliest_deadline_first() -> Column:
    """For a row with ``windows`` and ``slots``: the source of every slot."""

    def place(state: Column, slot: Column) -> Column:
        # the next block of each source, if it is released, by deadline
        following = F.zip_with(
            "windows",
            state["done"],
            lambda own, done: F.get(own, done),
        )
        ready = F.filter(
            F.transform(
                following,
                lambda w, i: F.struct(w["by"].alias("by"), i.alias("source"), w["release"].alias("at")),
            ),
            lambda w: w["at"] <= slot,
        )
        chosen = F.array_min(ready)["source"]
        return F.struct(
            F.transform(state["done"], lambda n, i: F.when(i == chosen, n + 1).otherwise(n)).alias(
                "done"
            ),
            F.concat(state["order"], F.array(chosen)).alias("order"),
        )

    start = F.struct(
        F.transform("windows", lambda w: F.lit(0)).alias("done"),
        F.array().cast("array<int>").alias("order"),
    )
    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1), start, place)["order"]


def _plan(sources: DataFrame) -> DataFrame:
    """Per source (``number``): arrays, one entry for each run of equal cycles: its first cycle,
    the slots before it, its slots per cycle, and the source's slots within the cycle."""
    one = sources.agg(
        F.sort_array(F.collect_list(F.struct("number", "weight", "blocks"))).alias("sources")
    )
    ends = F.transform("sources", lambda s: F.floor(s["blocks"] / s["weight"]))
    starts = F.array_sort(
        F.array_distinct(
            F.concat(F.array(F.lit(0).cast("long")), ends, F.transform(ends, lambda c: c + 1))
        )
    )
    runs = (
        one.withColumn("starts", starts)
        .select("sources", "starts", F.posexplode("starts").alias("run", "first"))
        .withColumn("cycles", F.get("starts", F.col("run") + 1) - F.col("first"))
        .withColumn("quota", _quota(F.col("first")))
        .withColumn(
            "slots", F.aggregate("quota", F.lit(0).cast("long"), lambda n, q: n + q)
        )
        .filter("slots > 0")
        .withColumn("windows", _windows())
        .withColumn("order", _earliest_deadline_first())
    )
    # at most two runs a source
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn(
        "before", F.coalesce(F.sum(F.col("cycles") * F.col("slots")).over(before), F.lit(0))
    )
    places = runs.select(
        "run", "first", "before", "slots", F.posexplode("order").alias("slot", "number")
    )
    by_run = places.groupBy("number", "run", "first", "before", "slots").agg(
        F.sort_array(F.collect_list("slot")).alias("own")
    )
    return by_run.groupBy("number").agg(
        F.sort_array(
            F.collect_list(F.struct("first", "before", "slots", "own"))
        ).alias("runs")
    )


def mix(
    documents: DataFrame,
    weights: dict[str | None, int] | None = None,
    other: int = 0,
    key: str = "doc_id",
    source: str = "source",
    block_rows: int = BLOCK_ROWS,
    cycle: int = CYCLE,
) -> tuple[DataFrame, tuple[str, str, str]]:
    """``documents`` with three more columns, whose names are returned too: number of the block
    within its source, its slot in the mixture, and the row's place in the block.  Reading by slot
    and place gives the mixture."""
    hashed, bucket, number, runs, rank, block, slot, row = fresh(
        documents, "hash", "range", "number", "runs", "rank", "source_block", "mix_slot", "mix_row"
    )
    origin = named(source)
    keyed = documents.select("*", F.xxhash64(named(key)).alias(hashed))
    slim = documents.select(origin.alias("source"), F.xxhash64(named(key)).alias("hash"))
    ranges = max(1, math.ceil(documents.count() / RANGE_ROWS))
    in_range = lambda c: F.pmod(F.shiftright(c, 20), F.lit(ranges).cast("long"))
    counts = cut(
        slim.withColumn("range", in_range(F.col("hash"))).groupBy("source", "range").agg(
            F.count("*").alias("rows")
        )
    )
    totals = counts.groupBy("source").agg(F.sum("rows").alias("rows"))
    if weights is None:
        share = F.sqrt("rows") / F.sum(F.sqrt("rows")).over(Window.partitionBy())
        weight = F.greatest(F.lit(1), F.round(share * cycle)).cast("long")
    else:
        weight = F.lit(other).cast("long")
        for name, slots in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(slots).cast("long")).otherwise(
                weight
            )
    # one row a source
    sources = cut(
        totals.select(
            "source",
            weight.alias("weight"),
            F.ceil(F.col("rows") / block_rows).alias("blocks"),
            (F.row_number().over(Window.orderBy("source")) - 1).alias("number"),
        )
    )
    if not sources.filter("weight < 1").isEmpty():
        raise ValueError("every source needs a positive weight")
    plan = sources.join(_plan(sources), "number").select("number", "source", "runs")
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.withColumn(
        "before", F.coalesce(F.sum("rows").over(earlier), F.lit(0).cast("long"))
    ).select(F.col("source").alias("of"), F.col("range").alias("at"), "before")
    plan = plan.select(F.col("source").alias("from"), F.col("runs").alias(runs))

    within = Window.partitionBy(origin, F.col(bucket)).orderBy(hashed, named(key))
    numbered = keyed.withColumn(bucket, in_range(F.col(hashed))).withColumn(
        rank, F.row_number().over(within)
    )
    offsets = offsets.join(plan, F.col("of").eqNullSafe(F.col("from"))).drop("from")
    placed = numbered.join(
        offsets, origin.eqNullSafe(F.col("of")) & (F.col(bucket) == F.col("at"))
    )
    place = F.col("before") + F.col(rank) - 1
    placed = (
        placed.withColumn(row, (place % block_rows).cast("int"))
        .withColumn(block, F.floor(place / block_rows))
    )
    # the run of cycles that the block falls in: its place there gives cycle and slot
    usual = F.size(F.get(F.col(runs), F.lit(0))["own"])
    cycle_of = F.floor(F.col(block) / usual)
    of_run = F.element_at(F.filter(F.col(runs), lambda r: r["first"] <= cycle_of), -1)
    chosen = (
        of_run["before"]
        + (cycle_of - of_run["first"]) * of_run["slots"]
        + F.get(of_run["own"], (F.col(block) % usual).cast("int"))
    )
    out = placed.withColumn(slot, chosen)
    return out.select(*[named(c) for c in documents.columns], block, slot, row), (block, slot, row)


def mixture(documents: DataFrame) -> DataFrame:
    """doc_id, source, source_block, mix_slot and mix_row of every document."""
    found, _ = mix(documents.select("doc_id", "source"))
    return found
