"""Mixing sources to target weights by weighted fair queueing.

Each source is shuffled by a hash of the document ids.  A document's virtual finish time is the number
of words its source has served up to and with it, divided by the source's target; a source that is
served again starts over where it ended.  All documents are then ordered by finish time and taken until
the budget is used up.

Running totals and the cut are found in two steps, so that no source and no range is ever one task:
rows are dealt into even buckets of the hash (or of the finish time), buckets are summed first, and
only the rows of one bucket are put in order.

Everything here is DataFrame operations.

Defined results
    null or empty text: size 0, taken 0.  A null source is a source, the last one.
    ties of the hash go by doc_id, then size; equal rows may swap places, which no column shows.
    a source without words has target 0 and takes nothing.  Empty table: no rows.
    null doc_id: the hash of an empty string; such rows are mixed like others.
    other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meanline.llm.filters import maybe_in
from meanline.sources.storage import shared_table

WORD = r"[^\x20\x09-\x0D]+"
#: Rows that a bucket holds on average.
BUCKET_ROWS = 2_000
_PLACE_BITS = 44


def shuffled_place() -> Column:
    """Where a document stands in its source's shuffle: 44 bits of a hash of the id."""
    digits = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, _PLACE_BITS // 4)
    return F.conv(digits, 16, 10).cast("bigint")


def source_targets(sources: DataFrame, weights: Sequence[int], share: float, repeats: int) -> DataFrame:
    """(source, weight, words) with each source's rank and ``target``.

    Targets are proportional to the weights and add up to ``share`` of all words; one that exceeds
    ``repeats`` times its source's words stops there, and the others take the excess by weight.  The table
    has one row a source.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("rank", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    )
    # sources in the order in which they reach their cap as the common level rises
    order = W.orderBy(F.col("words") / F.col("weight"), "rank")
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(W.currentRow, W.unboundedFollowing)
    level = (
        F.lit(share) * F.sum("words").over(W.partitionBy()) - repeats * F.coalesce(F.sum("words").over(before), F.lit(0))
    ) / F.sum("weight").over(after)
    leveled = ranked.withColumn("level", level).withColumn(
        "open", F.col("level") <= repeats * F.col("words") / F.col("weight")
    )
    common = F.first(F.when(F.col("open"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    settled = leveled.withColumn("common", common)
    capped = F.col("common").isNull() | (F.col("common") > repeats * F.col("words") / F.col("weight"))
    target = F.when(capped, F.col("words").cast("double") * repeats).otherwise(F.col("common") * F.col("weight"))
    return settled.select("source", "rank", "weight", "words", target.alias("target"))


def mix(
    documents: DataFrame, *, weights: Sequence[int] = (1, 2, 3), share: float = 1.0, repeats: int = 3,
    carry: Sequence[str] = (),
) -> DataFrame:
    """doc_id, source, size, source_size, target and ``taken`` for every row of ``documents``.

    Columns named in ``carry`` are kept as well.

    ``size`` counts words, ``taken`` the words the mix takes of the row: its size times 0 to ``repeats``.
    Weights go to the sources in order of their names, again from the start when they run out.
    """
    sized = shared_table(
        documents.select(
            "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
            shuffled_place().alias("place"), *carry,
        ),
        "sized",
    )
    sources = source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("words")), weights, share, repeats
    )
    rows, total = sized.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    budget = int(share * total)
    buckets = max(1, min(1 << 18, -(-rows // BUCKET_ROWS)))
    bucketed = sized.withColumn(
        "bucket", F.shiftright(F.col("place") * F.lit(buckets).cast("bigint"), _PLACE_BITS)
    )
    # words of earlier buckets of the same source
    offsets = (
        bucketed.groupBy("source", "bucket").agg(F.sum("size").alias("held"))
        .withColumn("served", F.sum("held").over(W.partitionBy("source").orderBy("bucket")) - F.col("held"))
        .select(F.col("source").alias("s"), F.col("bucket").alias("b"), "served")
    )
    inside = W.partitionBy("source", "bucket").orderBy("place", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    queued = (
        bucketed.withColumn("within", F.sum("size").over(inside))
        .join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
        .withColumn("end", F.col("served") + F.col("within")).drop("s", "b", "served", "within", "bucket")
    )
    named = sources.select(F.col("source").alias("s"), "rank", F.col("words").alias("source_size"), "target")
    queued = shared_table(
        queued.join(named, F.col("source").eqNullSafe(F.col("s"))).drop("s"), "queued"
    )
    finish = lambda turn: (turn * F.col("source_size") + F.col("end")) / F.col("target")
    cut = _cut(queued, finish, budget, buckets, repeats)
    taken = F.lit(0).cast("bigint")
    for turn in range(repeats):
        place = F.struct(finish(turn).alias("f"), F.col("rank").alias("r"), F.col("place").alias("p"),
                         F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"))
        taken = taken + F.when((F.col("target") > 0) & (place <= cut), F.col("size")).otherwise(F.lit(0).cast("bigint"))
    return queued.select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"), *carry
    )


def mixed(documents: DataFrame, **options) -> DataFrame:
    """The rows of ``documents`` that the mix takes, each as often as it is taken.

    Rows are found again by 128 bits of hashes over all their columns; texts move once.  Rows that are
    alike in every column share what they are given.
    """
    names = [f"`{f.name}`" for f in documents.schema.fields if not f.dataType.simpleString().startswith("map")]
    keyed = documents.withColumns({"_a": F.xxhash64(*names), "_b": F.xxhash64(F.lit(7), *names)})
    turns = shared_table(
        mix(keyed, carry=("_a", "_b"), **options).groupBy("_a", "_b").agg(
            F.sum(F.when(F.col("taken") > 0, F.col("taken") / F.col("size"))).cast("int").alias("_turns"),
            F.count(F.lit(1)).alias("_rows"),
        ).where("_turns > 0"),
        "turns",
    )
    single, copied = turns.where("_rows = 1"), turns.where("_rows > 1")
    copies = maybe_in(keyed, copied.select("_a"), "_a").dropDuplicates(["_a", "_b"])
    found = keyed.join(single, ["_a", "_b"]).unionByName(copies.join(copied, ["_a", "_b"]))
    return found.withColumn("_turn", F.explode(F.sequence(F.lit(1), F.col("_turns")))).select(*documents.columns)


def _cut(queued: DataFrame, finish, budget: int, buckets: int, repeats: int) -> Column:
    """The last place (finish, rank, place, id) in the order of all turns that the budget reaches.

    Bucket 0 ends at finish time 1, when every source has had its target; the buckets beyond are even.
    """
    turns = queued.where("target > 0 and size > 0").withColumn(
        "turn", F.explode(F.array(*[F.struct(finish(t).alias("f"), F.lit(t).alias("t")) for t in range(repeats)]))
    )
    f = F.col("turn.f")
    beyond = F.least(F.floor((f - 1) * F.lit(buckets)), F.lit(64 * buckets)).cast("bigint")
    placed = turns.withColumn("range", F.when(f <= 1, F.lit(0).cast("bigint")).otherwise(beyond + 1))
    ranges = placed.groupBy("range").agg(F.sum("size").alias("held"))
    running = ranges.withColumn("upto", F.sum("held").over(W.orderBy("range")))
    crossing = running.where(F.col("upto") > budget).orderBy("range").first()
    place = F.struct(f.alias("f"), F.col("rank").alias("r"), F.col("place").alias("p"),
                     F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"))
    if crossing is None:
        return F.struct(F.lit(float("inf")).alias("f"), F.lit(0).alias("r"), F.lit(0).cast("bigint").alias("p"),
                        F.lit("").alias("d"))
    left = budget - (crossing["upto"] - crossing["held"])
    ordered = placed.where(F.col("range") == crossing["range"]).select(place.alias("at"), "size")
    reached = ordered.withColumn("upto", F.sum("size").over(W.orderBy("at").rowsBetween(W.unboundedPreceding, 0)))
    last = reached.where(F.col("upto") <= left).agg(F.max("at").alias("at")).first()["at"]
    if last is None:
        # nothing of this range fits: the cut lies just before it
        edge = 1.0 if crossing["range"] == 1 else 1 + (crossing["range"] - 1) / buckets
        return F.struct(F.lit(edge if crossing["range"] else 0.0).alias("f"), F.lit(0).alias("r"),
                        F.lit(-1).cast("bigint").alias("p"), F.lit("").alias("d"))
    return F.struct(F.lit(last["f"]).alias("f"), F.lit(last["r"]).alias("r"), F.lit(last["p"]).cast("bigint").alias("p"),
                    F.lit(last["d"]).alias("d"))


#: The same in SQL, for the query over all documents.
MIX_SQL = r"""
with sized as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
    cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 11) as bigint) as place
  from documents
), ranked as (
  select source, cast(sum(size) as bigint) as words, row_number() over (order by source nulls last) as rank
  from sized group by source
), weighted as (
  select *, cast((rank - 1) % 3 + 1 as bigint) as weight from ranked
), leveled as (
  select *, (1.0::double * (sum(words) over ())::bigint - (3 * coalesce(sum(words) over
      (order by words / weight, rank rows between unbounded preceding and 1 preceding), 0))::bigint)
    / (sum(weight) over (order by words / weight, rank rows between current row and unbounded following))::double as level
  from weighted
), settled as (
  select *, (select first(l.level order by l.words / l.weight, l.rank) from leveled l
             where l.level <= 3 * l.words / l.weight) as common from leveled
), targets as (
  select source, rank, words, case when common is null or common > 3 * words / weight
    then 3 * words::double else common * weight end as target from settled
), queued as (
  select s.*, t.rank, t.words, t.target,
    (sum(s.size) over (partition by s.source order by place, doc_id, s.size rows unbounded preceding))::bigint as ends
  from sized s join targets t on s.source is not distinct from t.source
), turns as (
  select *, (turn * words + ends) / target as f from queued, (select unnest([0, 1, 2]) as turn) where target > 0
), reached as (
  select *, sum(size) over (order by f, rank, place, cast(doc_id as varchar) rows unbounded preceding) as upto from turns
), took as (
  select doc_id, source, size, place, ends, cast(sum(size) as bigint) as taken from reached
  where upto <= (select sum(size) from sized) group by doc_id, source, size, place, ends
)
select q.doc_id, q.size, q.words as source_size, q.target, coalesce(k.taken, 0) as taken
from queued q left join took k on q.doc_id is not distinct from k.doc_id and q.source is not distinct from k.source
  and q.size = k.size and q.ends = k.ends
"""
