"""Mixing sources to target weights: capped water-filling over sources, then seeded repetitions.

The level of the water is found in closed form from sources ordered by the level at which each is
full, so there is no loop. Whole repetitions are the same for all of a source's rows; the fractional
one goes to the rows that come first by a seeded hash. The hash range is cut into cells, summed per
source before the shuffle, so only the rows of the one cell that holds a source's border are ever
ordered: a source with a third of all rows is never gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keepsake.llm.tables import stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2.0
# The seeded order, 52 bits, is first looked at by its 12 leading ones.
_SHIFT = 40
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, epochs: float = MAX_EPOCHS
) -> DataFrame:
    """(source, source_size) -> the same with target: share * all sizes, divided by weight.

    Weights repeat over the sources by code point, null last. A target stops at epochs * size; what
    is cut off goes to the other sources by weight, until none is above. With share > epochs every
    source stops there. An empty source gets 0.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    order = Window.partitionBy(F.lit(1)).orderBy("full", "place")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = order.rowsBetween(1, Window.unboundedFollowing)
    cases = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.col("place") % len(weights) + 1).cast("int"),
    )
    placed = (
        sizes.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", cases)
        .withColumn("cap", F.col("source_size") * F.lit(float(epochs)))
        .withColumn("full", F.col("cap") / F.col("weight"))
        .withColumn("wanted", F.sum("source_size").over(everything) * F.lit(float(share)))
    )
    # A source is full if what it and the sources full before it hold, and the others at its
    # level, is no more than what is wanted.
    levels = (
        placed.withColumn("held", F.sum("cap").over(upto))
        .withColumn("open", F.coalesce(F.sum("weight").over(rest), F.lit(0.0)))
        .withColumn("is_full", F.col("held") + F.col("full") * F.col("open") <= F.col("wanted"))
    )
    totals = levels.withColumn(
        "poured", F.coalesce(F.sum(F.expr("if(is_full, cap, 0)")).over(everything), F.lit(0.0))
    ).withColumn(
        "thirst", F.coalesce(F.sum(F.expr("if(is_full, 0, weight)")).over(everything), F.lit(0.0))
    )
    level = (F.col("wanted") - F.col("poured")) / F.col("thirst")
    target = F.when(F.col("is_full"), F.col("cap")).otherwise(level * F.col("weight"))
    return totals.select("source", "source_size", target.alias("target"))


def _point(docs: DataFrame, seed: int, doc_id: str, text: str) -> Column:
    """A row's place in the seeded order of all rows, from 0 to 2**52 - 1: by its id and whole text,
    so that rows without an id, or with one id, have places of their own."""
    digest = F.md5(
        F.concat_ws(
            "|", F.lit(str(seed)), docs[doc_id].cast("string"), F.md5(docs[text].cast("binary"))
        )
    )
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def _rest(docs: DataFrame, *used: str) -> Column:
    """A number from all other columns: the order of rows with one id and text."""
    others = [docs[c] for c in docs.columns if c not in used]
    return F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0).cast("long")


def measured(docs: DataFrame, seed: int = 7, text="text", source="source", doc_id="doc_id"):
    """Every row's (key, source, size, point, rest), stored: what the plan is made from."""
    return stored(
        docs.select(
            docs[doc_id].alias("key"),
            docs[source].alias("source"),
            word_count(docs[text]).alias("size"),
            _point(docs, seed, doc_id, text).alias("point"),
            _rest(docs, doc_id, text, source).alias("rest"),
        ),
        "sizes",
    )


def plan(rows: DataFrame, weights=WEIGHTS, share=SHARE, epochs=MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target, whole, last, last_rest, ties, chosen) for each source of
    `measured` rows; stored, so that Spark knows its size before it is joined.

    A row is taken `whole` times, and once more if its (point, rest) is before (last, last_rest). Of
    the `ties` rows at that very place, equal in every column, `chosen` are taken once more. Rows are
    counted in until the next would go further past the target than it is now short of it, so taken
    words miss the target by half a row at most.
    """
    cells = stored(
        rows.groupBy("source", F.shiftright("point", _SHIFT).alias("cell")).agg(
            F.sum("size").alias("cell_size")
        ),
        "cells",
    )
    sources = source_targets(
        cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")),
        weights, share, epochs,
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = sources.withColumn("whole", F.floor(rate)).withColumn(
        "more", F.col("target") - F.col("whole") * F.col("source_size")
    )
    upto = Window.partitionBy("source").orderBy("cell")
    passed = F.sum("cell_size").over(upto.rowsBetween(Window.unboundedPreceding, 0))
    borders = (
        _by_source(cells.withColumn("passed", passed), sources.select("source", "more"))
        .where("passed > more")
        .groupBy("source", "more")
        .agg(F.min(F.struct("cell", F.expr("passed - cell_size as before"))).alias("b"))
        .select("source", "more", "b.cell", "b.before")
    )
    held = _by_source(rows.where("size > 0"), borders).where(
        F.shiftright("point", _SHIFT) == F.col("cell")
    )
    places = held.groupBy("source", "more", "before", "point", "rest").agg(
        F.count("*").alias("ties"), F.max("size").alias("size")
    )
    earlier = F.sum(F.col("ties") * F.col("size")).over(
        Window.partitionBy("source").orderBy("point", "rest").rowsBetween(Window.unboundedPreceding, -1)
    )
    short = F.col("more") - F.col("before") - F.coalesce(earlier, F.lit(0))
    fitting = F.when(
        F.col("size") / 2 <= short,
        F.greatest(F.lit(1), F.least("ties", F.floor(short / F.col("size") + 0.5))),
    )
    chosen = places.select("source", "point", "rest", "ties", fitting.alias("chosen"))
    inside = (
        chosen.where("chosen IS NOT NULL")
        .groupBy("source")
        .agg(F.max(F.struct("point", "rest", "ties", "chosen")).alias("inside"))
    )
    edge = F.shiftleft(F.col("cell"), _SHIFT) - 1
    lasts = borders.select("source", edge.alias("edge"))
    out = _by_source(_by_source(sources, lasts, "left"), inside, "left")
    last = F.when(F.col("more") <= 0, -1).otherwise(
        F.coalesce("inside.point", "edge", F.lit((1 << 52) - 1))
    )
    none = F.col("more") <= 0
    return stored(
        out.select(
            "source", "source_size", "target", "whole", last.alias("last"),
            F.when(~none, F.col("inside.rest")).alias("last_rest"),
            F.coalesce(F.when(~none, F.col("inside.ties")), F.lit(0)).alias("ties"),
            F.coalesce(F.when(~none, F.col("inside.chosen")), F.lit(0)).alias("chosen"),
        ),
        "plan",
    )


def _by_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Joined on source, null included; the left table's source stays."""
    right = right.withColumnRenamed("source", "_other")
    return left.join(right, F.col("source").eqNullSafe(F.col("_other")), how).drop("_other")


# Next to its source's plan: is a row one of the equal rows of which only some are taken?
_AT_BORDER = "ties > chosen AND point = last AND rest = last_rest"


def copies(tie: Column | None = None) -> Column:
    """How often a row with a place is taken, next to its source's plan; `tie` is its number, from
    1, among the equal rows at the border."""
    inside = F.expr("point < last OR (point = last AND (last_rest IS NULL OR rest <= last_rest))")
    inside = inside if tie is None else tie <= F.col("chosen")
    return (F.col("whole") + F.when(inside, 1).otherwise(0)).cast("long")


def _numbered(groups: DataFrame, n: str, out: str) -> DataFrame:
    """A row `out` = 1, 2... n for each group; large groups are spread over tasks."""
    step = 1 << 16
    blocks = groups.withColumn("_block", F.explode(F.expr(f"sequence(0, ({n} - 1) div {step})")))
    numbers = F.expr(f"sequence(_block * {step} + 1, least({n}, (_block + 1) * {step}))")
    return blocks.repartition("_block", n).withColumn(out, F.explode(numbers)).drop("_block", n)


def mix_counts(docs: DataFrame, seed: int = 7, **settings) -> DataFrame:
    """How often the mix takes each row: (key, source, size, source_size, target, copies, taken).

    key is the row's doc_id; size its words; target its source's words; taken = copies * size. A
    null or empty text has size 0 and is copied like others of its source. Rows with one id, or
    none, are ordered by their texts and then by their other columns; of rows equal in all, any may
    be the ones taken once more. A text is only counted and hashed, whatever its length. An empty
    table gives an empty table.
    """
    rows = measured(docs, seed)
    wanted = plan(rows, **settings)
    joined = _by_source(rows, wanted)
    columns = ["key", "source", "size", "source_size", "target"]

    def counted(df: DataFrame, tie: Column | None = None) -> DataFrame:
        taken = copies(tie)
        return df.select(*columns, taken.alias("copies"), (taken * F.col("size")).alias("taken"))

    if wanted.where("ties > chosen").isEmpty():
        return counted(joined)
    groups = joined.where(_AT_BORDER).groupBy(*columns, "whole", "chosen").agg(F.count("*").alias("_n"))
    ties = counted(_numbered(groups, "_n", "tie"), F.col("tie"))
    return counted(joined.where(f"({_AT_BORDER}) IS NOT TRUE")).union(ties)


def mixed(docs: DataFrame, seed: int = 7, **settings) -> DataFrame:
    """The mix itself: each row of `docs` as often as it is taken, with all of its columns.

    Only the plan, one row per source, is joined to the rows. It is stored first, so that Spark knows
    its size before it chooses the join: texts are shuffled only if there are too many sources for
    Spark to broadcast, or if some of a number of equal rows are taken: these are counted first.
    """
    wanted = plan(measured(docs, seed), **settings)
    tag, body = "_plan_source", "_body"
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias(body),
        docs["source"].alias("source"),
        _point(docs, seed, "doc_id", "text").alias("point"),
        _rest(docs, "doc_id", "text", "source").alias("rest"),
    )
    joined = rows.join(
        wanted.withColumnRenamed("source", tag), F.col("source").eqNullSafe(F.col(tag))
    )

    def repeated(df: DataFrame, tie: Column | None = None) -> DataFrame:
        times = copies(tie)
        copied = df.where(times > 0).select(body, F.explode(F.sequence(F.lit(1), times)).alias("_copy"))
        return copied.select(f"{body}.*")

    if wanted.where("ties > chosen").isEmpty():
        return repeated(joined)
    groups = joined.where(_AT_BORDER).groupBy(body, "whole", "chosen").agg(F.count("*").alias("_n"))
    ties = repeated(_numbered(groups, "_n", "tie"), F.col("tie"))
    return repeated(joined.where(f"({_AT_BORDER}) IS NOT TRUE")).union(ties)
