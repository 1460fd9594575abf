"""Repeated passages: bytes covered by a string of ``length`` bytes that also starts earlier in the corpus.

All starts of such strings are suffixes to compare on a prefix of fixed length.  As in the difference-cover
construction of suffix arrays, only a sample of positions is named and the others follow from it; the
cover is not taken by position but by content, so that it lies alike in equal strings:

1. Sample.  In every string of ``length`` bytes the block of ``BLOCK`` bytes with the smallest hash is its
   anchor.  Equal strings have their anchors at the same distance from their start, which is what a
   difference cover is for, and neighbouring strings share anchors, so there is one for some 35 bytes.
2. Names.  Anchor blocks are named by 64-bit hashes and counted over the corpus.  Strings around a block
   that stands only once cannot repeat and are done.
3. Regions.  All strings of one anchor lie in one region.  Regions are named as a whole; of equal regions
   the first holds the first occurrences and all strings of the others repeat.
4. Remaining suffixes.  Where one block has different regions (at the ends of repeats), the strings of its
   first regions are ordered by name and position, and adjacent ones compared: all but the first repeat.

Groups never meet in one task: counting and finding the first are pre-aggregated, joins are split by
Spark, and a block with very many different regions is compared string by string over all tasks.

Defined results
    null or empty text, or text shorter than ``length``: nothing is removed.
    null doc_id: nothing is removed, and the text removes nothing elsewhere.
    rows that repeat a doc_id share their removed ranges, as far as each text goes; equal rows keep both.
    empty table: no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meanline.llm.filters import maybe_in
from meanline.llm.text import BATCH_BYTES, Ranges, Texts, mix, pieces
from meanline.sources.storage import scratch, shared_table

LENGTH = 100
BLOCK = 32
#: Regions of one block that a task compares at once; blocks with more are compared string by string.
TASK_REGIONS = 2048
_POSITION_BITS = 22


def anchors(texts: Texts, hashes: Ranges, length: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First start, number of starts and anchor of each run of strings with one anchor, in order.

    The smallest block hash of every string is found by running minima over stretches as long as a
    string has blocks.  A hash keeps its high bits and takes its position as low bits: ties go left.
    """
    width = length + 1 - block
    n = len(texts.data) - length + 1
    if n < 1:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    rolled = hashes.rolling(block)
    low = np.uint64(max(_POSITION_BITS, int(len(rolled)).bit_length()))
    keyed = np.full(-(-len(rolled) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    keyed[: len(rolled)] = (rolled >> low << low) | np.arange(len(rolled), dtype=np.uint64)
    stretches = keyed.reshape(-1, width)
    upto = np.minimum.accumulate(stretches, axis=1).ravel()
    since = np.minimum.accumulate(stretches[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(since[:n], upto[width - 1 : width - 1 + n]) & np.uint64((1 << int(low)) - 1)
    sizes = np.diff(texts.offsets)
    inside = np.ones(n, bool)  # strings that do not reach into the next document
    for end, size in zip(texts.offsets[1:].tolist(), sizes.tolist(), strict=True):
        inside[max(end - size, end - length + 1, 0) : min(end, n)] = False
    starts = np.flatnonzero(inside)
    at = least[starts].astype(np.int64)
    first = np.ones(len(starts), bool)
    first[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    heads = np.flatnonzero(first)
    return starts[heads], np.diff(np.append(heads, len(starts))), at[heads]


def _regions(documents: DataFrame, length: int, block: int, named: bool) -> DataFrame:
    """One row for each anchor: block, and with ``named`` region, doc_id, start and number of strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches):
            with np.errstate(over="ignore"):
                hashes = Ranges(texts.data)
                starts, counts, at = anchors(texts, hashes, length, block)
                blocks = pa.array(hashes.hash(at, at + block).view(np.int64))
                if not named:
                    yield pa.RecordBatch.from_arrays([blocks], names=["block"])
                    continue
                whole = hashes.hash(starts, starts + counts + length - 1)
                whole = mix(whole ^ (at - starts).astype(np.uint64) << np.uint64(32) ^ counts.astype(np.uint64))
            of = texts.documents(starts)
            yield pa.RecordBatch.from_arrays(
                [blocks, pa.array(whole.view(np.int64)), batch.column("doc_id").take(pa.array(of)),
                 pa.array(((starts - texts.offsets[of]) << 16 | counts).astype(np.int64))],
                names=["block", "region", "doc_id", "place"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    rows = documents.where("doc_id is not null").select("doc_id", "text").where(F.octet_length("text") >= length)
    return rows.mapInArrow(run, f"block bigint, region bigint, doc_id {kind}, place bigint" if named else "block bigint")


def _strings(rows: DataFrame, documents: DataFrame, length: int) -> DataFrame:
    """``rows`` (block, doc_id, place, ...) with the bytes of their regions."""
    wanted = rows.select("doc_id").distinct()
    listed = rows.groupBy("doc_id").agg(F.collect_list(F.struct("block", "place")).alias("regions"))
    held = maybe_in(documents.select("doc_id", "text"), wanted, "doc_id").join(listed, "doc_id")
    kind = documents.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _ in pieces(batches):
            blocks, ids, places, held_bytes = [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "regions"))
            for doc_id, text, regions in zip(*columns, strict=True):
                data = (text or "").encode()
                for region in regions:
                    start, count = region["place"] >> 16, region["place"] & 0xFFFF
                    if start + count + length - 1 <= len(data):
                        blocks.append(region["block"])
                        ids.append(doc_id)
                        places.append(region["place"])
                        held_bytes.append(data[start : start + count + length - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), pa.array(ids, batch.schema.field("doc_id").type),
                 pa.array(places, pa.int64()), pa.array(held_bytes, pa.binary())],
                names=["block", "doc_id", "place", "bytes"],
            )

    return held.mapInArrow(cut, f"block bigint, doc_id {kind}, place bigint, bytes binary")


def _names(rows: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every string of ``length`` bytes in each region; the region it is in, and its place there."""
    data = np.frombuffer(b"".join(rows), np.uint8)
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    counts = sizes - length + 1
    of = np.repeat(np.arange(len(rows)), counts)
    inner = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = (np.cumsum(sizes) - sizes)[of] + inner
    with np.errstate(over="ignore"):
        return Ranges(data).hash(starts, starts + length), of, inner


def _runs(flags: np.ndarray, of: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Region, first place and number of the runs of flagged strings."""
    at = np.flatnonzero(flags)
    first = np.ones(len(at), bool)
    first[1:] = (at[1:] != at[:-1] + 1) | (of[at[1:]] != of[at[:-1]])
    heads = np.flatnonzero(first)
    return of[at[heads]], inner[at[heads]], np.diff(np.append(heads, len(at)))


def _compared(strings: DataFrame, length: int) -> DataFrame:
    """doc_id, first start and number of repeating strings; the regions of a block are compared in one task."""
    kind = strings.schema["doc_id"].dataType.simpleString()
    rows = strings.repartition("block").sortWithinPartitions("block", "doc_id", "place")

    def whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks = batch.column("block").to_numpy()
            if kept and kept[-1].column("block")[0].as_py() != blocks[0]:
                yield pa.Table.from_batches(kept)
                kept = []
            # the last block may go on in the next batch
            others = np.flatnonzero(blocks != blocks[-1])
            cut = int(others[-1]) + 1 if len(others) else 0
            if cut:
                yield pa.Table.from_batches([*kept, batch.slice(0, cut)])
                kept = []
            kept.append(batch.slice(cut))
        if kept:
            yield pa.Table.from_batches(kept)

    def parts(table: pa.Table) -> Iterator[pa.Table]:
        """The table cut between blocks into parts of a batch's bytes, or of one block."""
        blocks = table.column("block").to_numpy()
        upto = np.cumsum(pc.binary_length(table.column("bytes")).to_numpy())
        begin, ends = 0, np.append(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1, len(blocks))
        while begin < len(blocks):
            most = np.searchsorted(upto, (upto[begin - 1] if begin else 0) + BATCH_BYTES, "right")
            at = max(np.searchsorted(ends, most, "right") - 1, np.searchsorted(ends, begin, "right"))
            yield table.slice(begin, ends[at] - begin)
            begin = ends[at]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in (part for whole in whole_blocks(batches) for part in parts(whole)):
            names, of, inner = _names(table.column("bytes").to_pylist(), length)
            # rows come in the order of their blocks, documents and places, so a stable sort keeps the first first
            order = np.argsort(names, kind="stable")
            again = np.zeros(len(names), bool)
            again[order[1:]] = names[order][1:] == names[order][:-1]
            region, first, count = _runs(again, of, inner)
            starts = (table.column("place").to_numpy() >> 16)[region] + first
            ids = table.column("doc_id").combine_chunks().take(pa.array(region))
            yield pa.RecordBatch.from_arrays([ids, pa.array(starts), pa.array(count.astype(np.int64))], names=["doc_id", "start", "n"])

    return rows.mapInArrow(compare, f"doc_id {kind}, start bigint, n bigint")


def _compared_one_by_one(strings: DataFrame, length: int) -> DataFrame:
    """The same for blocks with too many regions for a task, which compares what it holds of them.

    Strings that a part of a task holds earlier as well repeat wherever the first one is; only the first of
    each string in a part is a row that meets those of other parts.
    """
    kind = strings.schema["doc_id"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TASK_REGIONS):
                part = pa.Table.from_batches([batch.slice(at, TASK_REGIONS)]).sort_by([("doc_id", "ascending"), ("place", "ascending")])
                names, of, inner = _names(part.column("bytes").to_pylist(), length)
                begin, ids = part.column("place").to_numpy() >> 16, part.column("doc_id").combine_chunks()
                starts, who = begin[of] + inner, ids.dictionary_encode().indices.to_numpy()[of]
                order = np.argsort(names, kind="stable")
                head = np.ones(len(order), bool)
                head[1:] = names[order][1:] != names[order][:-1]
                firsts = order[head]
                first = firsts[np.cumsum(head) - 1]
                again = np.zeros(len(names), bool)
                # rows that share a doc_id share its strings
                again[order] = (who[order] != who[first]) | (starts[order] != starts[first])
                region, place, count = _runs(again, of, inner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(names[firsts].view(np.int64), np.zeros(len(region), np.int64)),
                              mask=np.arange(len(firsts) + len(region)) >= len(firsts)),
                     ids.take(pa.array(np.append(of[firsts], region))),
                     pa.array(np.append(starts[firsts], begin[region] + place)),
                     pa.array(np.append(np.ones(len(firsts), np.int64), count.astype(np.int64)))],
                    names=["name", "doc_id", "start", "n"],
                )

    found = shared_table(strings.mapInArrow(split, f"name bigint, doc_id {kind}, start bigint, n bigint"), "strings")
    repeats, rows = found.where("name is null").drop("name"), found.where("name is not null").drop("n")
    first = rows.groupBy("name").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    others = rows.join(first.drop("n"), "name").where(F.struct("doc_id", "start") != F.col("first"))
    return repeats.unionByName(others.select("doc_id", "start", F.lit(1).cast("bigint").alias("n")))


def repeated_ranges(documents: DataFrame, length: int = LENGTH, block: int = BLOCK) -> DataFrame:
    """doc_id, start and n: the n strings of ``length`` bytes from byte ``start`` on also start earlier."""
    with scratch(documents.sparkSession) as keep:
        counted = shared_table(
            _regions(documents, length, block, False).groupBy("block").count().where("count > 1").select("block"), "blocks"
        )
        candidates = shared_table(_regions(documents, length, block, True).join(counted, "block", "left_semi"), "regions")
        first = shared_table(
            candidates.groupBy("region", "block").agg(F.min(F.struct("doc_id", "place")).alias("first")), "first-regions"
        )
        repeats = candidates.join(first.select("region", "first"), "region").where(
            F.struct("doc_id", "place") != F.col("first")
        ).select("doc_id", F.shiftright("place", 16).alias("start"), F.col("place").bitwiseAND(0xFFFF).alias("n"))
        sizes = first.groupBy("block").agg(F.count(F.lit(1)).alias("regions")).where("regions > 1")
        mixed = first.select("block", "first.doc_id", "first.place").join(sizes, "block")
        strings = shared_table(
            _strings(mixed, documents, length).join(sizes, "block"), "strings"
        )
        few, many = F.col("regions") <= TASK_REGIONS, F.col("regions") > TASK_REGIONS
        found = repeats.unionByName(_compared(strings.where(few).drop("regions"), length)).unionByName(
            _compared_one_by_one(strings.where(many).drop("regions"), length)
        )
        return keep(found, "repeats")


def _with_ranges(documents: DataFrame, repeats: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of all rows and their ``ranges`` (start, n), null where there are none."""
    ids = repeats.select("doc_id").distinct()
    listed = repeats.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("ranges"))
    touched = maybe_in(documents.select(*columns), ids, "doc_id").join(listed, "doc_id", "left")
    rest = maybe_in(documents.select(*columns), ids, "doc_id", keep=False)
    return touched.unionByName(rest.withColumn("ranges", F.lit(None).cast("array<struct<start:bigint,n:bigint>>")))


def _removed(size: int, ranges: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """The maximal removed runs of bytes."""
    runs: list[list[int]] = []
    for start, n in sorted((r["start"], r["n"]) for r in ranges or ()):
        end = min(start + n + length - 1, size)
        if start >= end:
            continue
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    return [(a, b) for a, b in runs]


def _kept(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for a, b in runs:
        parts.append(data[at:a])
        at = b
    return b"".join([*parts, data[at:]])


def summarize(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    rows = _with_ranges(documents, repeated_ranges(documents, length), ["doc_id", "text"])
    kind = documents.schema["doc_id"].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _ in pieces(batches):
            out = []
            for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                data = (text or "").encode()
                runs = _removed(len(data), ranges, length)
                out.append((len(data), sum(b - a for a, b in runs), len(runs), hashlib.sha256(_kept(data, runs)).hexdigest()))
            numbers = [pa.array([o[i] for o in out], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *numbers, pa.array([o[3] for o in out], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    return rows.mapInArrow(digest, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def remove_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """``documents`` with the repeated passages cut out of ``text``; characters are never torn.

    A column ``n_chars`` is brought up to date.
    """
    if "ranges" in documents.columns:
        raise ValueError("rename the column ranges first")
    rows = _with_ranges(documents, repeated_ranges(documents, length), documents.columns)
    schema = T.StructType(documents.schema.fields)

    def inner(data: bytes, a: int, b: int) -> tuple[int, int]:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        return a, b

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _ in pieces(batches):
            texts = []
            for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                if ranges and text:
                    data = text.encode()
                    text = _kept(data, [inner(data, a, b) for a, b in _removed(len(data), ranges, length)]).decode()
                texts.append(text)
            columns = {c: batch.column(c) for c in schema.names}
            columns["text"] = pa.array(texts, columns["text"].type)
            if "n_chars" in columns:
                counts = pa.array([None if t is None else len(t) for t in texts], pa.int64())
                columns["n_chars"] = counts.cast(columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return rows.mapInArrow(cut, schema)
