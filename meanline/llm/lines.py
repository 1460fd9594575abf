"""Repeated lines: two Bloom filters find the suspects, only suspects are shuffled and confirmed.

A line's key is the line without white space at its ends, A-Z lower-cased.  Each task marks the hashes
of its documents' keys in two bitmaps: hit once, and hit twice or more.  Pairs of bitmaps merge in any
order (what both hit once was hit twice), so the merge is an aggregation by chunk of the bitmap.  A key
of two documents is always marked twice; a line whose key is not cannot be repeated and stays where it
is.  For the others SHA-256 digests of the keys are shuffled, documents are counted exactly, and the
lines to drop go back to their documents.

Defined results
    null or empty text: one empty line, which has no key and stays; the text left is "".
    ties: with ``keep_first`` the line of the smallest doc_id (nulls last), then line number, stays.
    repeated rows: every row is a document; rows equal in doc_id and text are dropped from alike.
    very long texts: handled whole, one at a time.  Empty tables: an empty result.
    other columns: kept; one named like a result column (n_lines, n_dropped) gives way to it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meanline.llm.skew import join_totals
from meanline.llm.text import IN_WORD, LOWER_BYTE, Ranges, Texts, mix, pieces, runs
from meanline.sources.storage import scratch, shared_table

#: Bits of each bitmap; 16 MiB, the most that is sent to the driver and broadcast.  When it fills up
#: (some 10**8 different lines) more lines are suspects and shuffled; the result is the same.
FILTER_BITS = 1 << 27
#: Bytes of bitmap that travel as one row.
_CHUNK_BYTES = 1 << 13
_MERGE_TASKS = 16
_STARTS_CHARACTER = (np.arange(256) & 0xC0) != 0x80
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class Lines:
    """The lines of some texts: ``start`` and ``end`` of their keys, their ``document`` and ``number`` in it."""

    def __init__(self, texts: Texts, min_chars: int) -> None:
        data = texts.data
        breaks = np.flatnonzero(data == 10)
        starts = np.concatenate([texts.offsets[:-1], breaks + 1])
        self.document = np.concatenate([np.arange(texts.n), texts.documents(breaks)])
        order = np.lexsort([starts, self.document])
        starts, self.document = starts[order], self.document[order]
        last = np.append(self.document[1:] != self.document[:-1], True) if len(starts) else np.empty(0, bool)
        ends = np.where(last, texts.offsets[self.document + 1], np.append(starts[1:], 0) - 1)
        begins = runs(self.document, texts.n)
        self.number = np.arange(len(starts)) - begins[self.document]
        inked = np.flatnonzero(IN_WORD[data])
        left, right = np.searchsorted(inked, starts), np.searchsorted(inked, ends)
        keyed = left < right
        chars = np.concatenate([[0], np.cumsum(_STARTS_CHARACTER[data], dtype=np.int64)])
        self.start, self.end = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        self.start[keyed] = inked[left[keyed]]
        self.end[keyed] = inked[right[keyed] - 1] + 1
        keyed &= chars[self.end] - chars[self.start] >= min_chars
        self.document, self.number = self.document[keyed], self.number[keyed]
        self.start, self.end = self.start[keyed], self.end[keyed]
        self.hash = Ranges(data, LOWER_BYTE).hash(self.start, self.end)

    def once_each(self) -> np.ndarray:
        """One hash for every key of every document."""
        order = np.lexsort([self.hash, self.document])
        h, d = self.hash[order], self.document[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        return h[new]


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return (hashes % np.uint64(bits)).astype(np.int64), (mix(hashes) % np.uint64(bits)).astype(np.int64)


def _mark(once: np.ndarray, twice: np.ndarray, places: np.ndarray) -> None:
    """Set the bits of ``places`` in ``once``, and in ``twice`` where they repeat or were set before."""
    found, times = np.unique(places, return_counts=True)
    before = (once[found >> 3] >> (found & 7).astype(np.uint8)) & 1
    _set(twice, found[(times > 1) | (before == 1)])
    _set(once, found)


def _set(bitmap: np.ndarray, places: np.ndarray) -> None:
    """Set the bits of ``places``, which ascend."""
    if len(places):
        at, first = np.unique(places >> 3, return_index=True)
        bitmap[at] |= np.bitwise_or.reduceat(np.uint8(1) << (places & 7).astype(np.uint8), first)


def _packed(bitmap: np.ndarray) -> bytes:
    """A chunk as the places that are set, or as it is where that is shorter."""
    at = np.flatnonzero(np.unpackbits(bitmap, bitorder="little"))
    return at.astype("<u2").tobytes() if 2 * len(at) < len(bitmap) else bitmap.tobytes()


def _unpacked(stored: bytes) -> np.ndarray:
    if len(stored) == _CHUNK_BYTES:
        return np.frombuffer(stored, np.uint8).copy()
    bitmap = np.zeros(_CHUNK_BYTES, np.uint8)
    _set(bitmap, np.frombuffer(stored, "<u2").astype(np.int64))
    return bitmap


def _rows(chunks: Iterator[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    numbers, once, twice = [], [], []
    for number, a, b in chunks:
        if a.any():
            numbers.append(number)
            once.append(_packed(a))
            twice.append(_packed(b))
    return pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int32()), pa.array(once, pa.binary()), pa.array(twice, pa.binary())],
        names=["chunk", "once", "twice"],
    )


def seen_twice(df: DataFrame, text: str = "text", min_chars: int = 1, bits: int = FILTER_BITS) -> bytes:
    """The bitmap of places that keys of two or more documents, or two different keys, hit."""
    size = -(-bits // (8 * _CHUNK_BYTES)) * _CHUNK_BYTES

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
        for _, texts in pieces(batches, text):
            first, second = _places(Lines(texts, min_chars).once_each(), 8 * size)
            # a key whose two places coincide hits once
            _mark(once, twice, np.concatenate([first, second[second != first]]))
        for at in range(0, size, 64 * _CHUNK_BYTES):
            yield _rows((c // _CHUNK_BYTES, once[c : c + _CHUNK_BYTES], twice[c : c + _CHUNK_BYTES])
                        for c in range(at, min(size, at + 64 * _CHUNK_BYTES), _CHUNK_BYTES))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for number, *stored in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                a, b = map(_unpacked, stored)
                if number in held:
                    once, twice = held[number]
                    twice |= b | (once & a)
                    once |= a
                else:
                    held[number] = a, b
        for number, (a, b) in held.items():
            yield _rows(iter([(number, a, b)]))

    schema = "chunk int, once binary, twice binary"
    marked = df.select(text).mapInArrow(mark, schema).repartition(_MERGE_TASKS, "chunk").mapInArrow(merge, schema)
    found = np.zeros(size, np.uint8)
    for row in marked.select("chunk", "twice").collect():  # `bits` bits at most
        found[row.chunk * _CHUNK_BYTES : (row.chunk + 1) * _CHUNK_BYTES] = _unpacked(row.twice)
    return found.tobytes()


def suspects(df: DataFrame, marks: bytes, text: str = "text", min_chars: int = 1) -> DataFrame:
    """The lines of ``df`` (doc_key, doc_id, text) whose key may be repeated, each with the digest of its key.

    ``new`` tells a document's first line with that key.
    """
    shared = df.sparkSession.sparkContext.broadcast(marks)
    names = ["doc_key", "doc_id", "line", "digest", "new"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(shared.value, np.uint8)
        for batch, texts in pieces(batches, text):
            lines = Lines(texts, min_chars)
            held = [
                (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1
                for place in _places(lines.hash, len(bitmap) * 8)
            ]
            at = np.flatnonzero(held[0] & held[1])
            whole, digests, new, seen, document = texts.data.tobytes(), [], [], set(), -1
            for i in at.tolist():
                if lines.document[i] != document:
                    document, seen = lines.document[i], set()
                digest = hashlib.sha256(whole[lines.start[i] : lines.end[i]].translate(_LOWER)).digest()
                digests.append(digest)
                new.append(digest not in seen)
                seen.add(digest)
            documents = pa.array(lines.document[at])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(documents) for c in names[:2]), pa.array(lines.number[at].astype(np.int32)),
                 pa.array(digests, pa.binary()), pa.array(new, pa.bool_())],
                names=names,
            )

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.mapInArrow(find, f"doc_key binary, doc_id {kind}, line int, digest binary, new boolean")


def drop_repeated_lines(
    df: DataFrame, text: str = "text", *, min_documents: int = 2, min_chars: int = 1, keep_first: bool = True,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """``df`` without the lines whose key stands in ``min_documents`` documents or more, with n_lines and n_dropped.

    With ``keep_first`` the first of those lines in the corpus stays, otherwise all go.  Keys of fewer
    than ``min_chars`` code points stay.
    """
    if min_documents < 2:
        raise ValueError("a line of one document is not repeated")
    doc_key = F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.col(text))))
    added = ["n_lines", "n_dropped"]
    others = [c for c in df.columns if c != text and c not in added]
    with scratch(df.sparkSession) as keep:
        marks = seen_twice(df, text, min_chars, filter_bits)
        found = shared_table(suspects(df.select(doc_key.alias("doc_key"), "doc_id", text), marks, text, min_chars), "suspects")
        order = F.struct(F.col("doc_id").isNull(), "doc_id", "doc_key", "line")
        repeated = shared_table(
            found.groupBy("digest").agg(
                F.count_if("new").alias("documents"), F.count(F.lit(1)).alias("n"), F.min(order).alias("first")
            ).where(F.col("documents") >= min_documents).drop("documents"),
            "repeated-lines",
        )
        hits = join_totals(found, repeated, "digest", "n")
        if keep_first:
            hits = hits.where((F.col("doc_key") != F.col("first.doc_key")) | (F.col("line") != F.col("first.line")))
        dropped = hits.groupBy("doc_key").agg(F.collect_set("line").alias("dropped"))
        packed = df.select(
            doc_key.alias("doc_key"), F.struct(F.lit(0).alias("held"), *(F.col(f"`{c}`") for c in others)).alias("row"), text
        )
        result = packed.join(dropped, "doc_key", "left").select("row", F.col(text).alias("text"), "dropped")
        schema = T.StructType([
            result.schema["row"], T.StructField("text", T.StringType()),
            *(T.StructField(c, T.LongType(), False) for c in added),
        ])
        cleaned = result.mapInArrow(_without, schema)
        columns = [F.col("text").alias(text) if c == text else F.col(f"row.`{c}`") for c in df.columns if c not in added]
        return keep(cleaned.select(*columns, *added), "lines-left")


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the lines whose numbers are listed, and how many lines there were and went."""
    for batch in batches:
        counts, gone, left = [], [], []
        for held, dropped in zip(batch.column("text").to_pylist(), batch.column("dropped").to_pylist(), strict=True):
            lines = (held or "").split("\n")
            counts.append(len(lines))
            gone.append(len(dropped or ()))
            if dropped:
                drop = set(dropped)
                lines = [line for i, line in enumerate(lines) if i not in drop]
            left.append("\n".join(lines))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(left, pa.string()), pa.array(counts, pa.int64()), pa.array(gone, pa.int64())],
            names=["row", "text", "n_lines", "n_dropped"],
        )


LINES_SQL = """
with d as (select doc_id, row_number() over () as r, coalesce(text, '') as text from documents),
l as (select doc_id, r, unnest(string_split(text, chr(10))) as line,
  unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from d),
k as (select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as line_key from l),
f as (select line_key from k where line_key <> '' group by line_key having count(distinct r) >= 10),
m as (select k.*, f.line_key is not null as gone from k left join f using (line_key))
select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from m group by doc_id, r
"""
