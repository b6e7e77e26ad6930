"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

The mix is a sequence of slots of ``BLOCK`` words. Slot i falls on the golden-ratio point i of
the unit circle; the source whose interval of cumulative targets holds the point fills the slot
with its next block. A source's blocks are equal ranges of its words, its documents shuffled by
a hash; when they run out they start again, at most ``REPEATS`` times in all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profilelake.llm.common import stored

REPEATS = 3
#: Words per slot and block.
BLOCK = 256
#: Fraction bits of a point, and the golden ratio's fraction in them (odd: a full period).
POINT_BITS = 31
GOLDEN = 1327217885
#: Grid of the unit circle on which points meet source intervals.
CELLS = 4096
#: Slots that are ranked together.
RUN = 65536
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """``(source, source_size, target)`` of ``sizes (source, size)``.

    Sources, by code point and null last, weigh 1, 2, 3 and so on again, and share all words. A
    target stops at ``repeats`` times the source's size; the excess goes to the others by
    weight. The level (words per weight) of the rest follows from the sources in the order in
    which they fill up, without iterating. The rows are one per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per.withColumn("weight", (F.row_number().over(
        Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))) - 1) % 3 + 1)
    # cap / weight as an exact fraction over 6: weights are 1, 2 or 3
    filled = ranked.withColumns({
        "cap": F.col("source_size") * repeats,
        "level": F.expr(f"source_size * {repeats} * (6 div weight)"),
    })
    total, weights = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    order = Window.orderBy("level")
    upto = filled.groupBy("level").agg(F.sum("cap").alias("c"), F.sum("weight").alias("w"))
    # sources up to a level are full if the others, at that level, do not reach the total
    full = (
        upto.select("level", F.sum("c").over(order).alias("cap"), F.sum("w").over(order).alias("w"))
        # a total without the L is an int, and six of it pass the largest int from 358 million words on
        .where(f"w < {weights or 0} and 6 * cap + level * ({weights or 0} - w) <= 6L * {total or 0}L")
        .agg(F.max(F.struct("level", "cap", "w")).alias("s")).select("s.*").first()
    )
    top, cap, weight = full if full["level"] is not None else (-1, 0, 0)
    return filled.select(
        "source", "source_size",
        F.when(F.col("level") <= top, F.col("cap").cast("double"))
        .otherwise(F.lit(float((total or 0) - cap)) * F.col("weight") / float((weights or 1) - weight))
        .alias("target"),
    )


def _number(rows: DataFrame, within: list[str], amount: str, group: Column,
            order: list[Column | str], name: str) -> DataFrame:
    """``rows`` with the sum of ``amount`` over the rows before, by ``within``.

    Rows are ordered by ``group`` and in it by ``order``. The sums of the groups are added up
    first, so that a key with very many rows is dealt over its groups.
    """
    dealt = rows.withColumn("_group", group)
    key = Window.partitionBy(*within).orderBy("_group")
    before = dealt.groupBy(*within, "_group").agg(F.sum(amount).alias("_sum")).select(
        *within, "_group", (F.sum("_sum").over(key) - F.col("_sum")).alias("_before")
    )
    inside = Window.partitionBy(*within, "_group").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    return (
        dealt.withColumn("_inside", F.sum(amount).over(inside) - F.col(amount))
        .join(before, [*within, "_group"])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_group", "_before", "_inside")
    )


def schedule(targets: DataFrame, block: int = BLOCK, repeats: int = REPEATS) -> DataFrame:
    """``(source_no, slot, rank)``: the slots of each source, in order, numbered from 0.

    ``targets (source_no, source_size, target)``. There is a slot for every ``block`` words of
    all targets. A point meets the sources by equality on a grid cell, and then by its place.
    """
    spark = targets.sparkSession
    total = targets.agg(F.sum("target")).first()[0] or 0.0
    slots = int(total / block + 0.5)
    order = Window.orderBy("source_no")
    scale = float(1 << POINT_BITS)
    ends = targets.withColumn("_to", F.round(F.sum("target").over(order) / (total or 1.0) * scale)
                              .cast("long"))
    spread = ends.select(
        "source_no", F.lag("_to", 1, 0).over(order).alias("_from"), "_to"
    ).where("_from < _to").select(
        "source_no", "_from", "_to",
        F.explode(F.sequence(F.expr(f"_from div {(1 << POINT_BITS) // CELLS}"),
                             F.expr(f"(_to - 1) div {(1 << POINT_BITS) // CELLS}"))).alias("cell"),
    )
    points = spark.range(slots).select(
        F.col("id").alias("slot"),
        F.expr(f"((id % {1 << POINT_BITS}) * {GOLDEN}L) % {1 << POINT_BITS}").alias("point"),
    ).withColumn("cell", F.expr(f"point div {(1 << POINT_BITS) // CELLS}"))
    placed = points.join(spread, "cell").where("point >= _from and point < _to").select(
        "source_no", "slot", F.lit(1).alias("one")
    )
    return _number(placed, ["source_no"], "one", F.expr(f"slot div {RUN}"), ["slot"], "rank").drop(
        "one"
    )


def _in_place(docs: DataFrame, *more: Column, repeats: int = REPEATS) -> tuple[DataFrame, DataFrame]:
    """Rows with size, source_no and ``_start``, their place among the words of their source;
    and the targets, one row per source.
    """
    rows = docs.select("doc_id", "source", "text", *more).withColumns({
        "size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
        "_turn": F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")),
    })
    narrow = stored(rows.drop("text"), "mix-sizes")
    targets = stored(
        source_targets(narrow, repeats).withColumn("source_no", F.row_number().over(
            Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8")))),
        "mix-targets",
    )
    marked = narrow.join(targets, narrow.source.eqNullSafe(targets.source)).drop(targets.source)
    return stored(_number(
        marked, ["source_no"], "size",
        F.substring("_turn", 1, 3),  # 4,096 groups
        ["_turn", "doc_id", "size"], "_start",
    ), "mix-placed"), targets


def mixed(docs: DataFrame, *more: Column, block: int = BLOCK, repeats: int = REPEATS) -> DataFrame:
    """Per row of ``docs (doc_id, source, text)``: its size, source_size, target and taken.

    ``size`` counts words, null has none; ``taken`` the words that the mix takes from the row,
    repeats counted. Documents without words take part with 0. Rows with equal ids and sizes are
    alike and may change places, nothing else depends on the order of rows. Null sources are one
    source. An empty table gives no rows. Other columns are ignored, but for ``more``, narrow
    columns to pass along.
    """
    placed, targets = _in_place(docs, *more, repeats=repeats)
    # how often each block of a source is used: slots go round its blocks, at most ``repeats`` times
    turns = schedule(targets, block, repeats).join(
        targets.select("source_no", F.expr(f"(source_size + {block} - 1) div {block}").alias("n")),
        "source_no",
    ).where(f"n > 0 and rank < n * {repeats}")
    used = turns.groupBy("source_no", F.expr("rank % n").alias("block")).agg(
        F.count("*").alias("times")
    )
    pieces = placed.where("size > 0").withColumn(
        "block", F.explode(F.expr(f"sequence(_start div {block}, (_start + size - 1) div {block})"))
    ).withColumn("words", F.expr(
        f"least(_start + size, (block + 1) * {block}) - greatest(_start, block * {block})"
    ))
    taken = pieces.join(used, ["source_no", "block"]).groupBy("source_no", "_start").agg(
        F.sum(F.col("words") * F.col("times")).alias("taken")
    )
    passed = [c for c in placed.columns if c not in (
        "doc_id", "source", "size", "_turn", "source_no", "source_size", "target", "_start")]
    return placed.join(taken, ["source_no", "_start"], "left").select(
        "doc_id", *passed, "source", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).alias("taken"),
    )


def mix(docs: DataFrame, block: int = BLOCK, repeats: int = REPEATS) -> DataFrame:
    """``docs`` as the mix takes them, in the order of its slots: each row as often as its words
    were taken, to the nearest.

    The slots of a source read its words in the order of ``mixed``, ``block`` at a time, again and
    again, until its target is reached: all its words as often as the target holds them, and then
    the first of them. A copy of a row stands in the slot that reads its first word. Points may give
    a source some slots more or less than its target fills: those left over stay empty, and what
    is still short, as with sources of less than a block, stands after the last slot. So one
    document of a source is taken in part, and a source is off its target by half of it at most.
    Rows without words are not taken. All columns are kept; rows of one id and text count together
    and repeat the first of them.
    """
    row_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))
    row_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    placed, targets = _in_place(docs, row_id.alias("_id"), row_hash.alias("_hash"), repeats=repeats)
    whole = F.expr("cast(round(target) as long) div source_size")
    rest = F.expr("cast(round(target) as long) % source_size")
    times = (
        placed.where("size > 0")
        .withColumn("taken", F.col("size") * whole + F.greatest(
            F.least(F.col("size"), rest - F.col("_start")), F.lit(0)))
        .groupBy("_id", "_hash").agg(
            F.floor(F.sum("taken") / F.first("size") + 0.5).cast("int").alias("_times"),
            F.min(F.struct("source_no", "_start", "source_size")).alias("_first"))
        .where("_times > 0")
    )
    # the place of a copy's first word among all that the slots of its source read
    copies = times.select("_id", "_hash", "_first.*", F.explode(F.expr("sequence(0, _times - 1)")).alias("_turn")
                          ).withColumn("_place", F.expr("_turn * source_size + _start"))
    slots = schedule(targets, block, repeats).select(
        F.col("source_no").alias("_no"), F.col("rank").alias("_rank"), F.col("slot").alias("_slot"))
    ordered = copies.select(
        "_id", "_hash", F.col("source_no").alias("_no"), "_place", F.expr(f"_place div {block}").alias("_rank")
    ).join(slots, ["_no", "_rank"], "left")
    return (
        docs.withColumns({"_id": row_id, "_hash": row_hash}).dropDuplicates(["_id", "_hash"])
        .join(ordered, ["_id", "_hash"])
        .orderBy(F.asc_nulls_last("_slot"), "_no", "_place")
        .select(*docs.columns)
    )
