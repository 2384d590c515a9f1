"""Mixing sources to target weights along a time-varying curriculum, in DataFrame expressions only.

Every source has a weight schedule over training time, linear from its first to its last weight.
The integral of the schedules over time is each source's cumulative demand of tokens; a document's
place in its source's token stream, put into the inverse of that demand, is its training position.
Documents are range-sorted by position.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from squall.llm.common import words
from squall.storage import materialise

WEIGHTS = (5, 2, 1)  # of sources in order of code points, repeating
SHARE = 1.5  # of all words, what the mix takes
MAX_EPOCHS = 2  # how often a source, and so a document, may be taken
SLICES = 4096  # of each source's stream, by md5


def targets(
    sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """`(source, source_size, weight, target)` from `(source, source_size)`.

    Sources weigh by their rank, null last. What a source cannot take because it stops at
    `max_epochs` times its size goes to the others by weight, until none is above. Each round is one
    aggregate over the table of sources that returns one row; rounds are at most distinct weights and
    stopped sources.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    rank = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (rank + 1).cast("int"))
    ranked = materialise(sources.withColumn("weight", weight.cast("long")), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    most = F.col("source_size") * max_epochs
    free, held, level = ranked.agg(F.sum("weight")).first()[0] or 0, 0, 0.0
    stopped = F.lit(False)
    while free:
        level = (share * total - held) / free
        stopped = F.col("weight") * (share * total - held) / free > most
        row = ranked.agg(
            F.sum(F.when(stopped, most)), F.sum(F.when(~stopped, F.col("weight")))
        ).first()
        if (row[0] or 0, row[1] or 0) == (held, free):
            break
        held, free = row[0] or 0, row[1] or 0
    open_target = F.col("weight") * (share * total - held) / free if free else most.cast("double")
    target = F.when(stopped, most.cast("double")).otherwise(open_target) if free else open_target
    return ranked.withColumn("target", target.cast("double"))


def inverse_demand(part: Column, first: Column, last: Column) -> Column:
    """Time in [0, 1] by which `part` of a source's demand falls due.

    The weight runs linearly from `first` to `last`; its integral over time is
    `first * t + (last - first) * t * t / 2`, which is inverted.
    """
    slope = last - first
    due = part * (first + last) / 2
    root = F.sqrt(F.greatest(first * first + 2 * slope * due, F.lit(0.0)))
    return F.when(slope == 0, part).otherwise(2 * due / (first + root))


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
    max_epochs: int = MAX_EPOCHS, carry: Sequence[str] = (),
) -> DataFrame:
    """Each row of `docs (doc_id, text, source, …)` with what the mix takes of it and when.

    Columns: `doc_id, source, size, source_size, target, taken, positions`, and those in `carry`. A source's stream holds its
    documents in order of md5 of the id, whole stream after whole stream, and the mix takes its first
    `target` words (rounded): so the last document taken may be cut, and the words taken meet the
    target. `positions` has one training time for every time the document is taken.

    Null text has size 0 and is never taken; null sources are a source of their own; equal ids lie side
    by side, larger first. No window holds a whole source: sums over slices of the stream are added first.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    sized = docs.select(
        "doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"), key.alias("key"), *carry
    )
    slice_of = F.conv(F.substring("key", 1, 3), 16, 10).cast("int") % SLICES
    sized = materialise(sized.withColumn("slice", slice_of), "sizes")
    in_slices = materialise(
        sized.groupBy("source", "slice").agg(F.sum("size").alias("slice_size")), "slices"
    )
    of_source = targets(
        in_slices.groupBy("source").agg(F.sum("slice_size").alias("source_size")),
        weights, share, max_epochs,
    )
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = in_slices.select(
        "source", "slice", F.coalesce(F.sum("slice_size").over(before), F.lit(0)).alias("begin")
    )
    facts = begins.join(
        of_source, begins["source"].eqNullSafe(of_source["source"]), "inner"
    ).select(
        begins["source"].alias("at_source"), F.col("slice").alias("at_slice"), "begin",
        "source_size", "weight", "target",
    )
    within = Window.partitionBy("source", "slice").orderBy("key", F.desc("size"), "doc_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    run = sized.withColumn("upto", F.sum("size").over(within))
    placed = run.join(
        facts,
        F.col("source").eqNullSafe(F.col("at_source")) & (F.col("slice") == F.col("at_slice")),
        "inner",
    )
    start = F.col("begin") + F.col("upto") - F.col("size")
    demand = F.round("target").cast("long")
    epochs = range(max_epochs)
    part = [
        F.greatest(F.lit(0), F.least(F.col("size"), demand - start - e * F.col("source_size")))
        for e in epochs
    ]
    taken = part[0]
    for p in part[1:]:
        taken = taken + p
    # Heavy sources come early, light ones late: weights run from w to the mean weight.
    first, last = F.col("weight").cast("double"), F.lit(sum(weights) / len(weights))
    times = F.array(*[
        F.when(
            p > 0, inverse_demand((start + e * F.col("source_size")) / demand, first, last)
        ) for e, p in zip(epochs, part)
    ])
    return placed.select(
        "doc_id", "source", "size", "source_size", "target",
        taken.cast("long").alias("taken"), F.array_compact(times).alias("positions"), *carry,
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """One row for every time a document is taken, range-sorted by training position."""
    taken = mixed.withColumn("position", F.explode("positions")).drop("positions")
    return taken.sort("position", "doc_id")


def training_set(docs: DataFrame) -> DataFrame:
    """The mix of `docs (doc_id, text, source, …)` itself: one row, with its text, for every time a document is taken,
    range-sorted by training position.

    Columns: those of `docs`, then `size, source_size, target, taken, position`, which replace columns of
    these names. A document that the mix cuts is there whole; `taken` tells how many words count. Nulls, ties,
    repeated rows and empty tables are treated as in `mix`.

    The mix is made without the texts. They are joined to it by a digest of id, source and text, so texts move twice: to
    their positions' rows and into order. Rows alike in these three are told apart by turns; they meet in one task.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("doc_id", "source", "text")]
    keyed = docs.withColumn("__key", F.md5(F.concat_ws("\1", *parts).cast("binary")))
    numbers = ("size", "source_size", "target", "taken")
    kept = [c for c in docs.columns if c not in (*numbers, "position")]
    turn = F.row_number().over(Window.partitionBy("__key").orderBy(F.lit(0)))
    rows = keyed.select(*kept, "__key", turn.alias("__row"))
    mixed = mix(keyed, carry=("__key",)).select("__key", *numbers, "positions", turn.alias("__turn"))
    taken = mixed.filter(F.size("positions") > 0)
    # Not an equality of columns, so that the rows stay dealt by their key alone.
    both = rows.join(taken.withColumnRenamed("__key", "__other"), (F.col("__key") == F.col("__other")) & (F.col("__row") - F.col("__turn") == 0))
    return both.select(*kept, *numbers, F.explode("positions").alias("position")).sort("position", "doc_id")
