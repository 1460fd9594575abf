"""Keys that hold many rows, found by mergeable sketches and counted exactly.

A key with more rows than a good part of a task's share has to be parted by something else than itself.
Tasks keep frequent-item sketches of bounded size (of hashes, so keys may be of any type and number of
columns); merged, they name every key above the threshold, and some near it.  Only the rows of the keys
named are then counted, so no aggregation ever sees all keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bounds of the share: a key of more than one row in so many is frequent, so there are fewer such keys.
LEAST_SHARE, MOST_SHARE = 256, 5_000


def default_share(spark: SparkSession) -> int:
    """A quarter of a shuffle partition's rows is the most that a key may hold and stay whole."""
    return min(MOST_SHARE, max(LEAST_SHARE, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def _named(df: DataFrame, hashes: Mapping[str, Column], share: int) -> tuple[dict[str, list[int]], int]:
    """Per name the hashes that may be frequent, and the number of rows; one aggregation for all names."""
    # such a sketch errs by less than 1 / (2 * share) of the rows, so it names all keys above 1 / share
    items = [
        F.call_function("approx_top_k", value, F.lit(2 * share), F.lit(8 * share)).alias(str(i))
        for i, value in enumerate(hashes.values())
    ]
    row = df.agg(F.count(F.lit(1)).alias("total"), *items).first()
    total = row["total"]
    found = {
        name: [item["item"] for item in row[str(i)] or () if item["count"] * share > total]
        for i, name in enumerate(hashes)
    }
    return found, total


def frequent_keys(
    df: DataFrame, keys: Mapping[str, Sequence[Column]], share: int | None = None
) -> dict[str, list[tuple]]:
    """Per name, the keys (values of its columns, then the number of rows) of more than one row in ``share``.

    Two passes over the rows, however many names there are: one to sketch, one to count the rows of the
    keys that the sketches name.  Fewer than ``share`` keys a name reach the driver.
    """
    share = share or default_share(df.sparkSession)
    hashes = {name: F.xxhash64(*columns) for name, columns in keys.items()}
    named, total = _named(df, hashes, share)
    found: dict[str, list[tuple]] = {name: [] for name in keys}
    wanted = [name for name in keys if named[name]]
    if not wanted:
        return found
    kinds = {
        name: [f.dataType.simpleString() for f in df.select(*[c.alias(str(i)) for i, c in enumerate(keys[name])]).schema]
        for name in wanted
    }
    slots = sorted({(i, kind) for name in wanted for i, kind in enumerate(kinds[name])})
    entries = []
    for name in wanted:
        values = dict(zip([(i, kind) for i, kind in enumerate(kinds[name])], keys[name], strict=True))
        entries += [F.lit(name), hashes[name]]
        entries += [values.get(slot, F.lit(None).cast(slot[1])) for slot in slots]
    columns = [f"k{i}" for i in range(len(slots))]
    rows = df.select(F.stack(F.lit(len(wanted)), *entries).alias("name", "hash", *columns)).where(
        reduce(or_, [(F.col("name") == name) & F.col("hash").isin(named[name]) for name in wanted])
    )
    counts = rows.groupBy("name", *columns).agg(F.count(F.lit(1)).alias("n"))
    for row in counts.where(F.col("n") * share > F.lit(total)).collect():
        places = [slots.index((i, kind)) for i, kind in enumerate(kinds[row["name"]])]
        found[row["name"]].append((*(row[columns[place]] for place in places), row["n"]))
    return found
