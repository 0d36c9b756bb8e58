"""Analytics of training runs: best epochs, early stop, learning rate, summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxlake.session import written

# Epochs without improvement that stop a run; learning rate schedule.
STOP_PATIENCE = 10
LR_START, LR_FACTOR, LR_PATIENCE, LR_FLOOR = 1e-3, 0.5, 5, 1e-6
LR_THRESHOLD, LR_EPS = 1e-4, 1e-8

# Rows of one run that a task handles together.
EPOCHS_PER_BLOCK = 10_000


def with_best_before(log: DataFrame, block_size: int = EPOCHS_PER_BLOCK) -> DataFrame:
    """Adds `best_before`, the lowest loss of the earlier epochs of the run.

    A run is cut into blocks of epochs: block minima are aggregated, their running minimum is tiny,
    and only rows of one block meet in a task. A run that holds most of the table is thus shared out.
    """
    blocks = log.withColumn("block", F.floor(F.col("epoch") / F.lit(block_size)))
    earlier = W.partitionBy("run_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = (
        blocks.groupBy("run_id", "block").agg(F.min("val_loss").alias("low"))
        .select("run_id", "block", F.min("low").over(earlier).alias("low_before"))
    )
    inside = W.partitionBy("run_id", "block").orderBy("epoch").rowsBetween(W.unboundedPreceding, -1)
    return (
        blocks.join(before, ["run_id", "block"])
        .withColumn("best_before", F.least(F.min("val_loss").over(inside), "low_before"))
        .drop("block", "low_before")
    )


def best_epoch(log: DataFrame) -> DataFrame:
    """Adds `is_best`: a loss strictly below every earlier one; the first epoch always is."""
    improved = F.col("best_before").isNull() | (F.col("val_loss") < F.col("best_before"))
    return with_best_before(log).withColumn("is_best", improved).drop("best_before")


def early_stop(log: DataFrame, patience: int = STOP_PATIENCE) -> DataFrame:
    """Per run the epoch at which training stops, null when it runs to its end.

    Only the improving epochs matter: the run stops `patience` epochs after the first of them that
    is not followed by another in time. Epochs are numbered without gaps.
    """
    last = log.groupBy("run_id").agg(F.max("epoch").alias("last_epoch"))
    best = best_epoch(log).where("is_best").join(last, "run_id")
    following = F.lead("epoch").over(W.partitionBy("run_id").orderBy("epoch"))
    stop = F.col("epoch") + F.lit(patience)
    reached = (stop <= F.col("last_epoch")) & (F.col("next_best").isNull() | (F.col("next_best") > stop))
    return (
        best.withColumn("next_best", following)
        .groupBy("run_id")
        .agg(F.min(F.when(reached, stop)).alias("stop_epoch"), F.max("last_epoch").alias("last_epoch"))
    )


def plateau_lr(
    log: DataFrame,
    start: float = LR_START,
    factor: float = LR_FACTOR,
    patience: int = LR_PATIENCE,
    floor: float = LR_FLOOR,
    threshold: float = LR_THRESHOLD,
    eps: float = LR_EPS,
) -> DataFrame:
    """Replay of a reduce-on-plateau schedule: the learning rate after each epoch.

    An epoch improves when its loss is below the tracked best by the relative threshold. Between two
    improvements the rate falls once per `patience` + 1 epochs, so only the improvements have to be
    known. They are found among the strict minima of the run (for losses of at least 0
    every improvement is one); below 0 every epoch is a candidate. The rate follows by counting.
    """
    lowest = F.col("best_before")
    candidate = lowest.isNull() | (F.col("val_loss") < lowest) | (lowest < F.lit(0.0))
    points = with_best_before(log).where(candidate).select("run_id", "epoch", "val_loss")
    improved = _improvements(points, threshold)
    last = log.groupBy("run_id").agg(F.max("epoch").alias("last_epoch"))
    order = W.partitionBy("run_id").orderBy("since")
    until = F.coalesce(F.lead("since").over(order), F.col("last_epoch") + 1)
    spans = improved.join(last, "run_id").withColumn("until", until)
    cuts = F.floor((F.col("until") - F.col("since") - 1) / F.lit(patience + 1))
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    spans = spans.withColumn("cuts_before", F.coalesce(F.sum(cuts).over(earlier), F.lit(0).cast("long")))
    # every epoch lies in exactly one span, so the spans give the epochs back without a range join;
    # in two steps, so that a long span never becomes one long array
    size = F.lit(EPOCHS_PER_BLOCK)
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("until") - F.col("since") - 1) / size))
    first = F.col("since") + F.col("block") * size
    final = F.least(first + size, F.col("until").cast("long")) - 1
    epochs = (
        spans.select("run_id", "since", "until", "cuts_before", F.explode(blocks).alias("block"))
        .select("run_id", "since", "cuts_before", F.explode(F.sequence(first, final)).alias("epoch"))
        .withColumn("epoch", F.col("epoch").cast("int"))
    )
    done = F.col("cuts_before") + F.floor((F.col("epoch") - F.col("since")) / F.lit(patience + 1))
    steps = F.least(done, F.lit(_steps_to_floor(start, factor, floor, eps)))
    rate = F.element_at(F.array(*[F.lit(r) for r in _rates(start, factor, floor, eps)]), (steps + 1).cast("int"))
    return epochs.select("run_id", "epoch", rate.alias("lr"))


def _improvements(points: DataFrame, threshold: float) -> DataFrame:
    """(run_id, since): the points that improve on the tracked best by the relative threshold.

    Every point has one successor, the first later point that improves on it; the improvements are the chain that
    starts at the first point of the run. It is marked by pointer doubling: a round adds the points as many steps
    ahead as are marked already and doubles the steps, so a chain of n points takes log2(n) rounds of joins by
    point, and no run is replayed in order anywhere.
    """
    points = written(points.where(F.col("val_loss") < F.lit(float("inf"))), "points")
    bound = (F.col("val_loss") * F.lit(1.0 - threshold)).alias("bound")
    jumps = written(first_later_below(points, points.select("run_id", "epoch", bound)), "jumps")
    marked = [written(points.groupBy("run_id").agg(F.min("epoch").alias("epoch")), "marked")]
    while True:
        so_far = reduce(DataFrame.unionByName, marked)
        ahead = so_far.join(jumps, ["run_id", "epoch"]).select("run_id", F.col("later").cast(points.schema["epoch"].dataType).alias("epoch"))
        marked.append(written(ahead, "marked"))
        if marked[-1].isEmpty():
            return so_far.withColumnRenamed("epoch", "since")
        onward = jumps.select("run_id", F.col("epoch").alias("later"), F.col("later").alias("last"))
        jumps = written(jumps.join(onward, ["run_id", "later"]).select("run_id", "epoch", F.col("last").alias("later")), "jumps")


# Children of a node of the tree of minima below.
FAN = 128


def first_later_below(log: DataFrame, asked: DataFrame) -> DataFrame:
    """(run_id, epoch, later): for every row (run_id, epoch, bound) the first later epoch with a loss below its bound.

    Minima over blocks of FAN epochs, of FAN blocks and so on form a shallow tree per run, stored as a table per level. A
    row looks among the later siblings of its node, goes up until one has a minimum below the bound and from there
    down to the first epoch; each step is a join by node, and a node has FAN children at most.
    """
    top = log.agg(F.max("epoch")).first()[0] or 0
    kids = log.select("run_id", F.col("epoch").cast("long").alias("child"), F.col("val_loss").alias("low"))
    levels: list[DataFrame] = []
    while True:
        nodes = kids.groupBy("run_id", F.floor(F.col("child") / F.lit(FAN)).alias("parent")).agg(
            F.array_sort(F.collect_list(F.struct("child", "low"))).alias("kids")
        )
        levels.append(written(nodes, "minima"))
        if top < FAN:
            break
        top //= FAN
        least = F.array_min(F.transform("kids", lambda k: k["low"]))
        kids = levels[-1].select("run_id", F.col("parent").alias("child"), least.alias("low"))

    def first(condition) -> Column:
        return F.get(F.filter("kids", condition), F.lit(0))["child"]

    rows, hits = asked.withColumn("node", F.col("epoch").cast("long")), []
    for level in levels:
        parent = rows.withColumn("parent", F.floor(F.col("node") / F.lit(FAN)))
        found = first(lambda k: (k["child"] > F.col("node")) & (k["low"] < F.col("bound")))
        met = written(parent.join(level, ["run_id", "parent"]).withColumn("found", found).drop("kids"), "climbed")
        hits.append(met.where(F.col("found").isNotNull()).select("run_id", "epoch", "bound", F.col("found").alias("node")))
        rows = met.where(F.col("found").isNull()).select("run_id", "epoch", "bound", F.col("parent").alias("node"))
    reached = hits[-1]
    for level, hit in zip(levels[-2::-1], hits[-2::-1]):
        down = reached.join(level.withColumnRenamed("parent", "node"), ["run_id", "node"])
        reached = hit.unionByName(down.select("run_id", "epoch", "bound", first(lambda k: k["low"] < F.col("bound")).alias("node")))
    return reached.select("run_id", "epoch", F.col("node").alias("later"))


def _rates(start: float, factor: float, floor: float, eps: float) -> list[float]:
    """The rates a run can pass through; a cut of at most `eps` is not made."""
    rates = [float(start)]
    while True:
        lower = max(rates[-1] * factor, floor)
        if rates[-1] - lower <= eps:
            return rates
        rates.append(lower)


def _steps_to_floor(start: float, factor: float, floor: float, eps: float) -> int:
    return len(_rates(start, factor, floor, eps)) - 1


def run_summary(log: DataFrame) -> DataFrame:
    """Per run: epochs, best loss and its epoch, last loss, seconds from first to last row."""
    order = F.struct(-F.col("val_loss"), -F.col("epoch"))
    return log.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("n_epochs"),
        F.min("val_loss").alias("best_val_loss"),
        F.max_by("epoch", order).alias("best_epoch"),
        F.max_by("val_loss", "epoch").alias("last_val_loss"),
        (F.unix_seconds(F.max("logged_at").cast("timestamp")) - F.unix_seconds(F.min("logged_at").cast("timestamp")))
        .alias("total_seconds"),
    )
