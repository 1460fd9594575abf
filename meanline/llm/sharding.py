"""Sharding by best-fit-decreasing bin packing of groups that must not be torn apart.

Groups of equal texts, largest first, each go to the shard with the least room that still holds them.
Packing is done level by level, so that no task and not the driver sees all groups: groups are dealt
into even buckets, each bucket is packed into crates of one in ``4 / 5 * LAST_ITEMS`` of all bytes, and
crates are packed again as long as there are more than ``LAST_ITEMS``.  So at every size the final
packing into shards has items that are small beside a shard, or groups that cannot be smaller.  Its
capacity is the smallest at which the wanted number of shards is enough.  As that bounds the fullest
shard only, groups then move from the fullest shard to the emptiest for as long as it gets less full.

A group larger than a shard cannot stay together with any assignment of near equal sizes; it is split
by a hash of the ids into as few sixteenths of a shard as it needs, and those parts are packed.

Defined results
    null text: 8 bytes, grouped with the empty text.  A null doc_id is an id like any other.
    ties: equal groups are packed in the order of their digest, rows take slots by a hash of the id.
    repeated rows: each has a slot.  Empty table: no rows.  Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meanline.sources.storage import shared_table

#: Bytes that a row takes besides its text.
ROW_BYTES = 8
BUCKET_ITEMS = 20_000
#: Items of the final packing, at most; they are packed on the driver.
LAST_ITEMS = 50_000
_SLOT_ROWS = 20_000


def best_fit_decreasing(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The bin of each size; ``sizes`` come largest first.  None if more than ``most`` bins are needed.

    The room left in the bins is kept in order and searched by bisection.  A size above the capacity
    gets a bin of its own.
    """
    room: list[tuple[int, int]] = []
    bins, used = [], 0
    for size in sizes:
        at = bisect_left(room, (size, -1))
        if at < len(room):
            left, number = room.pop(at)
        else:
            left, number = max(capacity, size), used
            used += 1
            if most is not None and used > most:
                return None
        bins.append(number)
        insort(room, (left - size, number))
    return bins


def smallest_capacity(sizes: list[int], shards: int) -> tuple[int, list[int]]:
    """The least capacity at which ``shards`` bins are enough, as far as halving finds it, and the bins."""
    low = max([-(-sum(sizes) // shards), *sizes[:1]], default=0)
    high, bins = low, best_fit_decreasing(sizes, low, shards)
    step = max(1, low >> 12)
    while bins is None:
        low, high, step = high + 1, high + step, 2 * step
        bins = best_fit_decreasing(sizes, high, shards)
    while low < high:
        middle = (low + high) // 2
        found = best_fit_decreasing(sizes, middle, shards)
        if found is None:
            low = middle + 1
        else:
            high, bins = middle, found
    return high, bins


def levelled(sizes: list[int], bins: list[int], shards: int) -> list[int]:
    """``bins`` after moving sizes from the fullest bin that has one to spare to the emptiest, while that evens them out."""
    bins, load, held = list(bins), [0] * shards, [[] for _ in range(shards)]
    for item, (size, bin_) in enumerate(zip(sizes, bins, strict=True)):
        load[bin_] += size
        insort(held[bin_], (size, item))
    movable = set(range(shards))
    while movable:
        full, empty = max(movable, key=lambda b: (load[b], -b)), min(range(shards), key=lambda b: (load[b], b))
        gap = load[full] - load[empty]
        # the largest size that does not overshoot the middle, else the smallest that is still a gain
        at = bisect_right(held[full], (gap // 2, len(sizes))) - 1
        at = at if at >= 0 and held[full][at][0] else bisect_right(held[full], (0, len(sizes)))
        if at >= len(held[full]) or held[full][at][0] >= gap:
            movable.remove(full)  # what it holds is too large to move, and gaps only shrink
            continue
        size, item = held[full].pop(at)
        insort(held[empty], (size, item))
        bins[item] = empty
        load[full] -= size
        load[empty] += size
    return bins


def _crated(items: DataFrame, count: int, level: int, capacity: int) -> DataFrame:
    """(item, crate, bytes of the item): every bucket of items packed into crates of ``capacity`` bytes."""
    buckets = -(-count // BUCKET_ITEMS)

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["bytes", "item"], ascending=[False, True])
        bins = best_fit_decreasing(group["bytes"].tolist(), capacity)
        prefix = f"{level}-{group['bucket'].iloc[0]}-"
        return pd.DataFrame({"item": group["item"], "crate": [f"{prefix}{b}" for b in bins], "bytes": group["bytes"]})

    return (
        items.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(buckets)))
        .groupBy("bucket").applyInPandas(pack, "item string, crate string, bytes bigint")
    )


def assign(documents: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot for every row of ``documents`` (doc_id, text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = shared_table(
        documents.select(
            "doc_id", (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("digest"),
        ),
        "sized",
    )
    total, rows = sized.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    fair = max(1, -(-total // shards))
    groups = sized.groupBy("digest", "size").agg(F.count(F.lit(1)).alias("n"))
    # fewer than `shards` groups can be larger than a shard
    torn = groups.where(F.col("n") * F.col("size") > fair).collect()
    part = F.lit(0)
    for group in torn:
        parts = -(-16 * group["n"] * group["size"] // fair)
        part = F.when(
            (F.col("digest") == group["digest"]) & (F.col("size") == group["size"]),
            F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int"),
        ).otherwise(part)
    keyed = sized.withColumn("item", F.concat_ws("-", "digest", "size", part))
    items = shared_table(keyed.groupBy("item").agg(F.sum("size").alias("bytes")), "groups")
    holds, count, level = items.select("item", F.col("item").alias("crate")), items.count(), 0
    crate = max(1, -(-5 * total // (4 * LAST_ITEMS)))
    while level == 0 or count > LAST_ITEMS:
        level += 1
        # twice as large at each level, so that the number of crates falls
        packed = shared_table(_crated(items, count, level, crate << (level - 1)), "crates")
        items = shared_table(packed.groupBy(F.col("crate").alias("item")).agg(F.sum("bytes").alias("bytes")), "items")
        step = packed.select(F.col("item").alias("crate"), F.col("crate").alias("next"))
        holds = packed.select("item", "crate") if level == 1 else shared_table(
            holds.join(step, "crate").select("item", F.col("next").alias("crate")), "held"
        )
        count = items.count()
    last = sorted(((row["bytes"], row["item"]) for row in items.collect()), key=lambda x: (-x[0], x[1]))
    sizes = [size for size, _ in last]
    bins = levelled(sizes, smallest_capacity(sizes, shards)[1], shards)
    spark = documents.sparkSession
    shard_of = spark.createDataFrame(
        pd.DataFrame({"crate": [item for _, item in last], "shard": bins}), "crate string, shard int"
    ) if last else spark.createDataFrame([], "crate string, shard int")
    # at most LAST_ITEMS rows
    placed = holds.join(F.broadcast(shard_of), "crate").select("item", "shard")
    return _slotted(keyed.join(placed, "item").select("doc_id", "size", "text_crc32", "shard"), rows, shards)


def _slotted(rows: DataFrame, count: int, shards: int) -> DataFrame:
    """``rows`` with their place in the shard, counted from 0 without a gap; no shard is one task."""
    cells = max(1, -(-count // (shards * _SLOT_ROWS)))
    placed = shared_table(
        rows.withColumn("place", F.xxhash64("doc_id")).withColumn("cell", F.pmod("place", F.lit(cells))), "placed"
    )
    before = (
        placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.sum("n").over(W.partitionBy("shard").orderBy("cell")) - F.col("n")).drop("n")
    )
    within = F.row_number().over(W.partitionBy("shard", "cell").orderBy("place", "doc_id", "size", "text_crc32")) - 1
    return placed.withColumn("within", within).join(before, ["shard", "cell"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("within")).cast("bigint").alias("slot")
    )


def write_shards(documents: DataFrame, path: str, shards: int = 24) -> DataFrame:
    """Write the rows of ``documents`` as Parquet, one folder a shard; returns the assignment.  Ids must be unique."""
    assigned = shared_table(assign(documents, shards), "shards")
    (
        documents.join(assigned.select("doc_id", "shard", "slot"), "doc_id")
        .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    )
    return assigned
