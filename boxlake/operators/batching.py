"""Row order, batches, samples and padded examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxlake.operators.annotations import KEYS
from boxlake.schema import BATCH_SIZE, BOX_FIELDS, MAX_OBJECTS
from boxlake.session import written

# Order keys are whole numbers from 0 up to this bound.
KEY_BOUND = 2**31 - 1
# Width of the key ranges in which rows are numbered: 4,096 of them below the bound.
KEYS_A_BUCKET = 2**19
# Fixed value: multiplier of the arithmetic shuffle key.
KEY_FACTOR = 48271


def task_count(spark: SparkSession) -> int:
    """As many tasks as a shuffle is planned with, at least one per core."""
    planned = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, planned, spark.sparkContext.defaultParallelism)


def repartition_batch(frame: DataFrame) -> DataFrame:
    """Spread the rows evenly, before work that is heavy per row."""
    return frame.repartition(task_count(frame.sparkSession))


def packed_files(frame: DataFrame) -> DataFrame:
    """A scan of many small files in as many tasks as a shuffle is planned with, without a shuffle.

    Spark counts every file as 4 MB when it packs files into tasks, so that a task would hold a few small files only.
    """
    return frame.coalesce(task_count(frame.sparkSession))


def spread_by(frame: DataFrame, on: Sequence[str]) -> DataFrame:
    """Hash-partition by `on` into at least one partition per core.

    For groups whose work is heavy next to their bytes: sized by bytes alone, they would be
    packed into too few tasks.
    """
    return frame.repartition(task_count(frame.sparkSession), *on)


def clustered_by(frame: DataFrame, on: Sequence[str]) -> DataFrame:
    """`spread_by`, but rows that a shuffle has dealt by columns of `on` already, to at least one task per core, stay
    where they are."""
    plan = frame._jdf.queryExecution().sparkPlan()
    held = plan.outputPartitioning()
    if held.getClass().getSimpleName() != "HashPartitioning":
        return spread_by(frame, on)
    names = {a.exprId().toString(): a.name() for a in (plan.output().apply(i) for i in range(plan.output().size()))}
    keys = [held.expressions().apply(i) for i in range(held.expressions().size())]
    dealt = [names.get(k.exprId().toString()) if k.getClass().getSimpleName() == "AttributeReference" else None for k in keys]
    lies_so = all(name in on for name in dealt) and held.numPartitions() >= frame.sparkSession.sparkContext.defaultParallelism
    return frame if lies_so else spread_by(frame, on)


# Bits of the map of hashed keys that `maybe_among` sends to all tasks: 8 MB.
KEY_BITS = 2**26


def maybe_among(frame: DataFrame, others: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key `on` may be among the keys of `others`, without moving them.

    A row stays if the bit of its hashed key is set by some key of `others`. So every row with such a key stays, and of the
    rest a share that grows with the keys (0.013 for a million); an exact join has to follow.
    """
    place = F.pmod(F.xxhash64(*on), F.lit(KEY_BITS))
    maps = others.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("key_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("key_bits")
    )
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("key_bits", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    placed = frame.withColumn("key_bucket", F.bitmap_bucket_number(place)).join(F.broadcast(maps), "key_bucket")
    return placed.where(F.getbit(byte, (bit % 8).cast("int")) == 1).select(*frame.columns)


def shuffle_key(number: Column, seed: int = 0) -> Column:
    """Seeded order key of a whole number, the same in any engine."""
    return (number * F.lit(KEY_FACTOR) + F.lit(seed)) % F.lit(KEY_BOUND)


def name_key(name: Column, seed: int = 0) -> Column:
    """Seeded order key of a name."""
    return F.pmod(F.xxhash64(name, F.lit(seed)), F.lit(KEY_BOUND).cast("long"))


def with_ordinal(
    frame: DataFrame, key: Column, tie: Sequence[str], by: Sequence[str] = (), width: int = KEYS_A_BUCKET
) -> DataFrame:
    """Adds `ordinal`, 0 for the first row of each `by` group in (key, tie) order.

    Rows are numbered inside buckets of `width` keys and every bucket starts where the ones of its group before it end,
    so the rows are read twice, and a group that holds most of the table is numbered by many tasks. `key` must be a
    whole number: either one of the keys above, which spread the rows over 4,096 buckets, or a row number, of which a
    bucket holds at most `width`. Rows of one key are numbered by one task.
    """
    by = list(by)
    keyed = frame.withColumn("order_key", key).withColumn("bucket", F.floor(F.col("order_key") / F.lit(width)))
    before = W.partitionBy(*by).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        keyed.groupBy(*by, "bucket").agg(F.count(F.lit(1)).alias("held"))
        .select(*by, "bucket", F.coalesce(F.sum("held").over(before), F.lit(0).cast("long")).alias("start"))
    )
    inside = W.partitionBy(*by, "bucket").orderBy("order_key", *tie)
    return (
        keyed.join(starts, [*by, "bucket"])
        .withColumn("ordinal", F.col("start") + F.row_number().over(inside) - F.lit(1))
        .drop("bucket", "start", "order_key")
    )


def with_row_number(frame: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds `row_no`, a long, 1 for the first row in the order of the columns; equal rows in any order.

    The rows are sorted in ranges and written with their range and place in it; every range starts where the ones before
    it end. No task holds more than a range.
    """
    place = F.monotonically_increasing_id()
    ranges = frame.repartitionByRange(task_count(frame.sparkSession), *order).sortWithinPartitions(*order)
    # such an id is the number of the range, then 33 bits of place
    held = written(ranges.select("*", F.shiftright(place, 33).alias("row_range"), (place % F.lit(1 << 33)).alias("row_place")), "row-numbers")
    before = W.orderBy("row_range").rowsBetween(W.unboundedPreceding, -1)
    starts = held.groupBy("row_range").agg(F.count(F.lit(1)).alias("held")).select(
        "row_range", F.coalesce(F.sum("held").over(before), F.lit(0).cast("long")).alias("row_start")
    )
    numbered = held.join(F.broadcast(starts), "row_range").withColumn("row_no", F.col("row_start") + F.col("row_place") + 1)
    return numbered.select(*frame.columns, "row_no")


def make_batches(
    images: DataFrame, key: Column, order: Column, tie: Sequence[str] = ("image_name",), batch_size: int = BATCH_SIZE
) -> DataFrame:
    """Batch number per split: the train split in key order, the others in table `order`; the last batch may be short."""
    place = F.when(F.col("split_name") == "train", key).otherwise(order)
    numbered = with_ordinal(images, place, tie, by=["split_name"])
    return numbered.withColumn("batch_id", F.floor(F.col("ordinal") / F.lit(batch_size)))


def store_ordered(images: DataFrame, path: str, key: Column, tie: Sequence[str] = ("image_name",), row_group_bytes: int = 1 << 20) -> None:
    """Write the rows with their `ordinal` in key order, sorted by it within and across files.

    The extremes that Parquet keeps for every file and row group then tell where a position lies.
    """
    numbered = with_ordinal(images, key, tie)
    tasks = max(int(images.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = numbered.repartitionByRange(tasks, "ordinal").sortWithinPartitions("ordinal")
    ordered.write.mode("overwrite").option("parquet.block.size", row_group_bytes).parquet(path)


def image_at(spark: SparkSession, path: str, index: int) -> DataFrame:
    """Name of the example at a position of a table written by `store_ordered`: a pushed-down filter, no shuffle."""
    return spark.read.parquet(path).where(F.col("ordinal") == F.lit(index)).select("ordinal", "image_name")


def sample_images(images: DataFrame, key: Column, n: int = 24) -> DataFrame:
    """`n` items without replacement (all when there are fewer), chosen by a seeded key."""
    return images.orderBy(key, "image_name").limit(n)


def first_objects(labels: DataFrame, on: Sequence[str] = KEYS, n: int = MAX_OBJECTS) -> DataFrame:
    """The first `n` boxes of each image in box order, with their `slot`.

    Spark keeps only `n` rows per image and task before the shuffle.
    """
    order = W.partitionBy(*on).orderBy(*BOX_FIELDS)
    return (
        labels.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= F.lit(n))
        .withColumn("slot", F.col("rank") - 1)
        .drop("rank")
    )


def pad_column(
    cls: Column, reg: Column, mask: Column, n: int = MAX_OBJECTS
) -> tuple[Column, Column, Column]:
    """Class, box and mask arrays cut or zero-filled to length `n`.

    A missing mask entry counts as 1; a missing or short box stays zero; null arrays are empty.
    """
    zero, one = F.lit(0.0), F.lit(1.0)
    slots = F.sequence(F.lit(0), F.lit(n - 1))
    count = F.coalesce(F.size(cls), F.lit(0))

    def when_used(i: Column, value: Column) -> Column:
        return F.when(i < count, value).otherwise(zero)

    def padded_box(i: Column) -> Column:
        box = F.get(reg, i)
        usable = (i < count) & (F.coalesce(F.size(box), F.lit(0)) >= F.lit(4))
        return F.array(*[
            F.when(usable, F.get(box, F.lit(j)).cast("double")).otherwise(zero) for j in range(4)
        ])

    return (
        F.transform(slots, lambda i: when_used(i, F.get(cls, i).cast("double"))),
        F.transform(slots, padded_box),
        F.transform(slots, lambda i: when_used(i, F.coalesce(F.get(mask, i).cast("double"), one))),
    )


def pad_targets(images: DataFrame, labels: DataFrame, on: Sequence[str] = KEYS, n: int = MAX_OBJECTS) -> DataFrame:
    """One fixed-length example per image: `cls[n]`, `reg[n][4]`, `mask[n]`, zero-filled."""
    on = list(on)
    held = first_objects(labels, on, n).groupBy(*on).agg(
        F.array_sort(F.collect_list(F.struct("slot", *BOX_FIELDS))).alias("boxes")
    )
    # Named first: inside a lambda an inlined array would be built again for every slot. The names differ
    # from those of the result, which would hide them inside the lambdas.
    lists = spread_by(images.select(*on), on).join(held, on, "left").select(
        *on,
        F.transform("boxes", lambda b: b["class_id"]).alias("classes"),
        F.transform("boxes", lambda b: F.array(b["cx"], b["cy"], b["w"], b["h"])).alias("corners"),
        F.transform("boxes", lambda b: F.lit(1.0)).alias("marks"),
    )
    cls, reg, mask = pad_column(F.col("classes"), F.col("corners"), F.col("marks"), n)
    return lists.select(*on, cls.alias("cls"), reg.alias("reg"), mask.alias("mask"))


def num_pos(mask: Column) -> Column:
    """Objects marked in a mask, at least 1."""
    return F.greatest(F.aggregate(mask, F.lit(0.0), lambda total, m: total + m), F.lit(1.0))
