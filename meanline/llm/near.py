"""Near-duplicate documents: MinHash bands propose pairs, sequential Bayesian tests prune them, full sets decide.

1. One pass hashes the distinct word shingles of every whole text: set size, a 128-bit fingerprint of
   the set and a MinHash signature.  Documents with the same set become one node.
2. Signatures are cut into bands.  Nodes that share a band form a bucket.
3. A bucket first proposes a star: each node with the bucket's most connected node.  A proposed pair is
   read batch by batch of signature values; as soon as the posterior probability that its similarity
   reaches the threshold falls below ``miss`` it is dropped.  Survivors are compared on their full sets.
4. Buckets whose nodes are still in different components compare all pairs across components, in
   blocks inside tasks, by the same test with a longer signature; survivors are compared on their full
   sets.  So no link is lost to the star, and pairs of a large group of copies are never written out.

Signature length follows from the threshold: enough bands that a pair at the threshold shares none with
probability ``miss`` at most.

Defined results
    null or empty text, or text without words: an empty set, linked with nothing.
    null doc_id: a document of its own, component null, kept.
    rows with the same doc_id are one document; ties resolve to the smallest doc_id.
    empty table: no rows.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meanline.llm.components import components
from meanline.llm.filters import maybe_in
from meanline.llm.text import LOWER_BYTE, Ranges, mix, pieces, runs, shingles
from meanline.sources.storage import scratch, shared_table

BAND_ROWS = 5
MISS = 1e-6
#: Signature values compared before each decision.
BATCH = 20
#: Nodes of a bucket that one task compares with as many others.
BLOCK = 1024
#: One-byte signature values that the pairs left over are compared by.
SKETCH = 1024
#: The low bits of a bucket's key number its band.
_BAND_BITS = 6


def band_count(percent: int, miss: float = MISS, rows: int = BAND_ROWS) -> int:
    """Bands needed so that a pair at the threshold has none in common with probability ``miss`` at most."""
    shared = (percent / 100) ** rows
    return 1 if shared >= 1 else math.ceil(math.log(miss) / math.log(1 - shared))


def least_matches(percent: int, length: int, miss: float = MISS, batch: int = BATCH) -> list[tuple[int, int]]:
    """(values read, matches below which a pair is dropped) for every decision.

    With a uniform prior the similarity after m matches in n values is Beta(m + 1, n - m + 1); the
    probability that it reaches t equals that of at most m successes in n + 1 trials at t.
    """
    t = percent / 100
    decisions = []
    for n in [*range(batch, length, batch), length]:
        tail, m = 0.0, 0
        while m <= n:
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if tail >= miss:
                break
            m += 1
        decisions.append((n, m))
    return decisions


def _document_sets(texts, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a shorter text is one shingle."""
    starts, ends, documents = texts.words()
    words = Ranges(texts.data, LOWER_BYTE).hash(starts, ends)
    windows, of = shingles(words, documents, width)
    at, word_at = runs(of, texts.n), runs(documents, texts.n)
    sets = []
    for i in range(texts.n):
        found = windows[at[i] : at[i + 1]]
        if not len(found) and word_at[i + 1] > word_at[i]:
            whole = np.uint64(word_at[i + 1] - word_at[i])
            for word in words[word_at[i] : word_at[i + 1]]:
                whole = mix(np.array([whole * np.uint64(5) + word]))[0]
            found = np.array([whole], np.uint64)
        sets.append(np.unique(found))
    return sets


def _signed(df: DataFrame, width: int, length: int) -> DataFrame:
    """doc_id, set size, fingerprint and signature of every row."""
    factors = mix(np.arange(1, length + 1, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
    masks = (mix(np.arange(1, length + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            with np.errstate(over="ignore"):
                sets = _document_sets(texts, width)
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            a, b = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
            signatures = np.zeros((len(full), length), np.uint32)
            if len(full):
                flat = np.concatenate([sets[i] for i in full])
                at = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                a[full] = np.add.reduceat(mix(flat), at)
                b[full] = np.bitwise_xor.reduceat(mix(flat ^ np.uint64(0x5851F42D4C957F2D)), at)
                short = (flat >> np.uint64(32)).astype(np.uint32)
                for j in range(length):
                    signatures[:, j] = np.minimum.reduceat((short ^ masks[j]) * factors[j], at)
            rows: list[bytes | None] = [None] * len(sets)
            for place, i in enumerate(full):
                rows[i] = signatures[place].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                 pa.array(rows, pa.binary())],
                names=["doc_id", "n_shingles", "set_a", "set_b", "signature"],
            )

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.select("doc_id", "text").mapInArrow(
        sign, f"doc_id {kind}, n_shingles bigint, set_a bigint, set_b bigint, signature binary"
    )


def _banded(nodes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(key, node) for every band of every node."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32)
            values = values.reshape(batch.num_rows, -1)[:, : bands * rows].astype(np.uint64)
            keys = np.empty((batch.num_rows, bands), np.uint64)
            for band in range(bands):
                key = np.full(batch.num_rows, band + 1, np.uint64)
                for row in range(rows):
                    key = mix(key * np.uint64(3) + values[:, band * rows + row])
                keys[:, band] = (key << np.uint64(_BAND_BITS)) | np.uint64(band)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), batch.column("node").take(pa.array(np.repeat(np.arange(batch.num_rows), bands)))],
                names=["key", "node"],
            )

    kind = nodes.schema["node"].dataType.simpleString()
    return nodes.select("node", "signature").mapInArrow(cut, f"key bigint, node {kind}")


def _agree(left: np.ndarray, right: np.ndarray, decisions: list[tuple[int, int]]) -> np.ndarray:
    """Row by row, whether the pair of signatures passes every decision; most pairs stop at the first."""
    alive, matches, read = np.arange(len(left)), np.zeros(len(left), np.int32), 0
    for n, least in decisions:
        matches = matches + (left[alive, read:n] == right[alive, read:n]).sum(1, dtype=np.int32)
        stays = matches >= least
        alive, matches, read = alive[stays], matches[stays], n
    return alive


def _plausible(pairs: DataFrame, nodes: DataFrame, decisions: list[tuple[int, int]]) -> DataFrame:
    """The pairs (a, b) whose signatures pass the sequential test."""
    held = pairs.join(nodes.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a").join(
        nodes.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b"
    )

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sides = [
                    np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, -1)
                    for c in ("sa", "sb")
                ]
                yield batch.select(["a", "b"]).take(pa.array(_agree(*sides, decisions)))

    return held.select("a", "b", "sa", "sb").mapInArrow(test, pairs.select("a", "b").schema)


def _sets(wanted: DataFrame, documents: DataFrame, width: int, sketch: int = 0) -> DataFrame:
    """(node, members): the sorted shingle hashes of every node of ``wanted``.

    With ``sketch`` also that many more signature values of one byte each.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    factors = mix(np.arange(1, sketch + 1, dtype=np.uint64) << np.uint64(20)).astype(np.uint32) | np.uint32(1)
    masks = (mix(np.arange(1, sketch + 1, dtype=np.uint64) << np.uint64(20)) >> np.uint64(32)).astype(np.uint32)

    def bytes_of(members: np.ndarray) -> bytes:
        short = (members >> np.uint64(32)).astype(np.uint32)
        values = np.full(sketch, 0xFFFFFFFF, np.uint32)
        for at in range(0, len(short), 256):
            part = short[at : at + 256]
            np.minimum(values, ((part[None, :] ^ masks[:, None]) * factors[:, None]).min(1), out=values)
        return (mix(values.astype(np.uint64)) & np.uint64(255)).astype(np.uint8).tobytes()

    def collect_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            with np.errstate(over="ignore"):
                sets = _document_sets(texts, width)
                columns = [batch.column("doc_id"), pa.array([s.tobytes() for s in sets], pa.binary())]
                if sketch:
                    columns.append(pa.array([bytes_of(s) for s in sets], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["node", "members", "sketch"][: len(columns)])

    found = maybe_in(documents.select("doc_id", "text"), wanted.toDF("doc_id"), "doc_id").mapInArrow(
        collect_sets, f"node {kind}, members binary" + (", sketch binary" if sketch else "")
    )
    return shared_table(found.join(wanted.toDF("node"), "node", "left_semi"), "sets")


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common) > 0


def _linked(
    pairs: DataFrame, documents: DataFrame, width: int, percent: int, sets: DataFrame | None = None
) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold."""
    if sets is None:
        sets = _sets(pairs.select("a").union(pairs.select("b")).distinct(), documents, width)
    held = pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("ma")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("members").alias("mb")), "b"
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = (
                [np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column(c)] for c in ("ma", "mb")
            )
            good = [i for i, (x, y) in enumerate(zip(*sides, strict=True)) if _similar(x, y, percent)]
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    return held.select("a", "b", "ma", "mb").mapInArrow(compare, pairs.select("a", "b").schema).distinct()


def _across(
    members: DataFrame, nodes: DataFrame, sets: DataFrame, decisions: list[tuple[int, int]],
    finer: list[tuple[int, int]], rows: int,
) -> DataFrame:
    """Plausible pairs (a, b) of one bucket that lie in different components.

    ``members`` holds (key, node, component, main, all, most) of the buckets with several components.  All
    nodes outside a bucket's largest component meet all nodes of the bucket, block by block; a task holds
    two blocks at a time.  A pair is looked at in the first band it shares, first by its signature, then
    by the longer one-byte signature.
    """
    held = members.join(nodes.select("node", "signature").join(sets.select("node", "sketch"), "node"), "node")
    block = lambda n: F.greatest(F.lit(1), F.ceil(n / F.lit(BLOCK)).cast("int"))
    few, many = block(F.col("all") - F.col("most")), block(F.col("all"))
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    place = F.pmod(F.xxhash64("node"), F.lit(1 << 30))
    columns = ("key", "node", "component", "signature", "sketch")
    minor = held.where("component != main").select(
        *columns, F.pmod(place, few).cast("int").alias("i"), spread(many).alias("j")
    )
    every = held.select(
        *(F.col(c).alias(f"with_{c}") for c in columns), spread(few).alias("with_i"),
        F.pmod(place, many).cast("int").alias("with_j"),
    )

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.rename_columns([c.removeprefix("with_") for c in right.column_names])
        kind, length = left.schema.field("node").type, decisions[-1][0]
        a, b = [], []
        if left.num_rows and right.num_rows:
            band = left.column("key")[0].as_py() & ((1 << _BAND_BITS) - 1)
            (nx, cx, sx, lx), (ny, cy, sy, ly) = (
                (
                    t.column("node").to_pylist(), np.asarray(t.column("component").to_pylist()),
                    np.frombuffer(b"".join(t.column("signature").to_pylist()), np.uint32).reshape(t.num_rows, length),
                    np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(t.num_rows, -1),
                )
                for t in (left, right)
            )
            for i in range(len(nx)):
                others = np.flatnonzero(cy != cx[i])
                found = others[_agree(np.broadcast_to(sx[i], (len(others), length)), sy[others], decisions)]
                shared = (sy[found] == sx[i]).reshape(len(found), length // rows, rows).all(2)
                found = found[shared.argmax(1) == band]
                for j in found[_agree(np.broadcast_to(lx[i], (len(found), lx.shape[1])), ly[found], finer)].tolist():
                    a.append(min(nx[i], ny[j]))
                    b.append(max(nx[i], ny[j]))
        return pa.table({"a": pa.array(a, kind), "b": pa.array(b, kind)})

    kind = nodes.schema["node"].dataType.simpleString()
    return minor.groupBy("key", "i", "j").cogroup(every.groupBy("with_key", "with_i", "with_j")).applyInArrow(
        meet, f"a {kind}, b {kind}"
    ).distinct()


def near_duplicates(
    documents: DataFrame, *, shingle_words: int = 5, percent: int = 80, miss: float = MISS, band_rows: int = BAND_ROWS
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``documents`` (doc_id, text).

    Two documents are linked when their sets of ``shingle_words``-word shingles are at least
    ``percent`` % similar (intersection over union); a component is what links reach.
    """
    bands = band_count(percent, miss, band_rows)
    if bands > 1 << _BAND_BITS:
        raise ValueError(f"{bands} bands are needed; take fewer rows a band or a larger miss probability")
    length = bands * band_rows
    decisions = least_matches(percent, length, miss)
    with scratch(documents.sparkSession) as keep:
        signed = shared_table(_signed(documents, shingle_words, length), "signed")
        usable = signed.where("n_shingles > 0 and doc_id is not null")
        copies = shared_table(
            # equal sets have equal signatures
            usable.groupBy("set_a", "set_b", "n_shingles").agg(
                F.min("doc_id").alias("node"), F.any_value("signature").alias("signature")
            ),
            "copies",
        )
        member = shared_table(
            usable.select("doc_id", "set_a", "set_b", "n_shingles")
            .join(copies.drop("signature"), ["set_a", "set_b", "n_shingles"])
            .select("doc_id", "node"),
            "copy-members",
        )
        # one row for each set: its first document carries the signature
        nodes = copies.select("node", "signature")
        several = shared_table(nodes.groupBy("node").count().where("count > 1").select("node"), "nodes-of-several-sets")
        if not several.isEmpty():  # rows that repeat a doc_id with another text
            nodes = shared_table(nodes.dropDuplicates(["node"]), "nodes")
        banded = shared_table(_banded(nodes, bands, band_rows), "bands")
        shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        buckets = shared_table(banded.join(shared, "key"), "buckets")
        reach = buckets.groupBy("node").agg(F.sum("n").alias("reach"))
        centre = (
            buckets.join(reach, "node").groupBy("key")
            .agg(F.max_by("node", F.struct("reach", F.xxhash64("node"))).alias("centre"))
        )
        star = (
            buckets.join(centre, "key").where("node != centre")
            .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct()
        )
        plausible = shared_table(_plausible(star, nodes, decisions), "plausible")
        links = shared_table(_linked(plausible, documents, shingle_words, percent), "links")
        first = components(links)
        placed = buckets.join(first, "node", "left").select(
            "key", "node", F.coalesce("component", "node").alias("component")
        )
        sizes = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
        shape = sizes.groupBy("key").agg(
            F.max(F.struct("n", "component")).getField("component").alias("main"), F.sum("n").alias("all"),
            F.max("n").alias("most"), F.count(F.lit(1)).alias("parts"),
        ).where("parts > 1")
        mixed = shared_table(placed.join(shape, "key"), "mixed-buckets")
        sets = _sets(mixed.select("node").distinct(), documents, shingle_words, SKETCH)
        finer = least_matches(percent, SKETCH, miss, SKETCH // 8)
        rest = _across(mixed, nodes, sets, decisions, finer, band_rows).join(plausible, ["a", "b"], "left_anti")
        rest = shared_table(rest, "across")
        links = links.unionByName(shared_table(_linked(rest, documents, shingle_words, percent, sets), "links"))
        # documents of one set, and rows of one document with several sets, belong together as well
        same = member.where("doc_id != node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
        found = components(links.unionByName(same))
        result = (
            signed.select("doc_id", "n_shingles")
            .join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
        )
        return keep(result, "near-duplicates")
