"""Order of hits per request: top-k, ranks over unbounded result lists, and auto-cut."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkloom.operators.storage import materialize

# Up to this top a window per request is cheap: each task sends it at most top hits.
WINDOW_TOP = 1_000
SPREAD = 16
ORDER = ("distance", "chunk_id", "tenant")


def top_k(
    hits: DataFrame, largest_top: int, order: tuple[str, ...] = ORDER, from_all_tasks: bool = True
) -> DataFrame:
    """At most ``top`` nearest hits per request, with their ``rank`` from 1.

    The literal bound lets Spark cut each partition before the shuffle; the column bound then
    applies each request's own ``top``. Where every task of the scan can send ``top`` hits of a request,
    they are first cut in ``SPREAD`` groups of a request by different tasks, and only what is left
    of these meets in one.
    """
    if from_all_tasks:
        group = Window.partitionBy("request_id", F.pmod(F.hash("chunk_id"), F.lit(SPREAD))).orderBy(*order)
        hits = hits.withColumn("rank", F.row_number().over(group)).where(F.col("rank") <= largest_top).drop("rank")
    place = Window.partitionBy("request_id").orderBy(*order)
    ranked = hits.withColumn("rank", F.row_number().over(place))
    best = ranked.where((F.col("rank") <= largest_top) & (F.col("rank") <= F.col("top")))
    return best.withColumn("rank", F.col("rank").cast("bigint"))


def rank_all(hits: DataFrame, order: tuple[str, ...] = ORDER) -> DataFrame:
    """Ranks without a bound on the hits per request.

    A window per request would put all hits of one request in one task. Here the hits are sorted
    by range over all tasks (ties are spread by the id in the sort key), numbered within each
    partition, and shifted by the number of hits in the partitions before. The numbered rows are
    checkpointed, because a second computation could cut the ranges elsewhere. The sort reads its
    input twice, to find the ranges and to sort, so the hits are shuffled once before it rather
    than scored twice.
    """
    spread = hits.repartition("request_id", "chunk_id")
    numbered = materialize(
        spread.orderBy("request_id", *order).withColumn("pos", F.monotonically_increasing_id())
    ).withColumn("part", F.shiftright("pos", 33))
    # sorted by request: at most one row per request and per partition
    counts = numbered.groupBy("request_id", "part").agg(
        F.count("*").alias("n"), F.min("pos").alias("start")
    )
    before = Window.partitionBy("request_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    shifts = counts.select(
        "request_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("start")).alias("shift")
    )
    joined = numbered.join(shifts, ["request_id", "part"])
    ranked = joined.withColumn("rank", F.col("pos") + F.col("shift") + 1).drop("pos", "part", "shift")
    return ranked.where(F.col("top").isNull() | (F.col("rank") <= F.col("top")))


def _bulge(rank: Column, total: Column, value: Column, low: Column, high: Column) -> Column:
    """How far the scaled distance lies above the scaled rank; null when there is no spread."""
    return (value - low) / F.nullif(high - low, F.lit(0.0)) - (rank - 1) / F.nullif(
        total - 1, F.lit(0)
    )


def auto_cut(ranked: DataFrame) -> DataFrame:
    """Keep the first ``auto_limit`` groups of similar distance of each request.

    Rank and distance are scaled to [0, 1]; a new group starts at each hit that rises above the
    diagonal more than both its neighbours. The last hit is compared with the two before it.
    All windows share one partitioning by request.
    """
    whole = Window.partitionBy("request_id")
    in_order = whole.orderBy("rank")
    bulge = _bulge(
        F.col("rank"),
        F.max("rank").over(whole),
        F.col("distance"),
        F.min("distance").over(whole),
        F.max("distance").over(whole),
    )
    marked = ranked.withColumn("bulge", bulge)
    here = F.col("bulge")
    below = F.lag("bulge", 1).over(in_order)
    other = F.coalesce(F.lead("bulge", 1).over(in_order), F.lag("bulge", 2).over(in_order))
    starts = F.coalesce((here > below) & (here > other), F.lit(False)).cast("int")
    grouped = marked.withColumn("starts", starts).withColumn(
        "cut_group", F.sum("starts").over(in_order)
    )
    wanted = F.col("auto_limit").isNull() | (F.col("auto_limit") <= 0)
    return grouped.where(wanted | (F.col("cut_group") < F.col("auto_limit"))).drop(
        "bulge", "starts", "cut_group"
    )


def auto_cut_first(first: DataFrame) -> DataFrame:
    """``auto_cut`` of the first hits of each request, told the ``total, low, high`` of all of them.

    Adds ``cut_group`` and ``settled``: whether these hits hold the place of the cut, or are all there
    are. The last of them has no neighbour behind it, so it is only judged where it ends the whole list.
    """
    whole = Window.partitionBy("request_id")
    in_order = whole.orderBy("rank")
    bulge = _bulge(F.col("rank"), F.col("total"), F.col("distance"), F.col("low"), F.col("high"))
    marked = first.withColumn("bulge", bulge)
    here, below = F.col("bulge"), F.lag("bulge", 1).over(in_order)
    ends = F.col("rank") == F.col("total")
    other = F.when(ends, F.lag("bulge", 2).over(in_order)).otherwise(F.lead("bulge", 1).over(in_order))
    starts = F.coalesce((here > below) & (here > other), F.lit(False)).cast("int")
    grouped = marked.withColumn("starts", starts).withColumn("cut_group", F.sum("starts").over(in_order))
    settled = (F.max("rank").over(whole) == F.col("total")) | (
        F.max("cut_group").over(whole) >= F.col("auto_limit")
    )
    return grouped.withColumn("settled", settled).drop("bulge", "starts")


def auto_cut_all(ranked: DataFrame, largest_limit: int) -> DataFrame:
    """``auto_cut`` for result lists without a bound.

    Neighbours meet by an equi-join on (request, rank), which spreads evenly, and only the first
    ``auto_limit`` group starts of a request are ever brought together.
    """
    limited = ranked.where(F.col("auto_limit") > 0)
    spread = limited.groupBy("request_id").agg(
        F.max("rank").alias("total"), F.min("distance").alias("low"), F.max("distance").alias("high")
    )
    marked = limited.join(spread, "request_id").select(
        "request_id",
        "rank",
        "auto_limit",
        "total",
        _bulge(
            F.col("rank"), F.col("total"), F.col("distance"), F.col("low"), F.col("high")
        ).alias("bulge"),
    )
    # every hit tells its neighbours how far it bulges; the last-but-two tells the last
    last_but_two = F.col("rank") == F.col("total") - 2
    told = F.filter(
        F.array(
            F.struct((F.col("rank") + 1).alias("rank"), F.lit("below").alias("side")),
            F.struct((F.col("rank") - 1).alias("rank"), F.lit("other").alias("side")),
            F.when(
                last_but_two,
                F.struct((F.col("rank") + 2).alias("rank"), F.lit("other").alias("side")),
            ),
        ),
        lambda t: t.isNotNull(),
    )
    heard = marked.select("request_id", "bulge", F.explode(told).alias("to")).select(
        "request_id", F.col("to.rank").alias("rank"), F.col("to.side").alias("side"), "bulge"
    )
    own = marked.select(
        "request_id", "rank", F.lit("own").alias("side"), "bulge", "auto_limit"
    )
    joined = own.unionByName(heard, allowMissingColumns=True).groupBy("request_id", "rank").agg(
        *[
            F.max(F.when(F.col("side") == side, F.col("bulge"))).alias(side)
            for side in ("own", "below", "other")
        ],
        F.max("auto_limit").alias("auto_limit"),
    )
    starts = joined.where((F.col("own") > F.col("below")) & (F.col("own") > F.col("other")))
    nth = Window.partitionBy("request_id").orderBy("rank")
    numbered = starts.withColumn("nth", F.row_number().over(nth)).where(
        (F.col("nth") <= largest_limit) & (F.col("nth") == F.col("auto_limit"))
    )
    ends = numbered.select("request_id", F.col("rank").alias("end_rank"))
    return (
        ranked.join(ends, "request_id", "left")
        .where(F.col("end_rank").isNull() | (F.col("rank") < F.col("end_rank")))
        .drop("end_rank")
    )
