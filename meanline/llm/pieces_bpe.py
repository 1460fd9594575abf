"""SentencePiece encoding and decoding of merge-type models by a prefix table.

For each prefix of a chunk the table stores the last token of its encoding, which is unique: of the
pieces that end there (found by an automaton over all pieces) it is the one that is compatible with the
last token of the prefix before it.  Two tokens are compatible when merging their characters by the
model's ranks gives the same two tokens back.  Ids are then read off backwards.

No piece reaches from another character into a space mark, so a text falls into chunks (space marks and
what follows them) that are encoded on their own; characters outside the model cut chunks further and
become byte tokens.  Encoded chunks are remembered, within a fixed number.

Defined results
    null or empty text: the end id only (with ``add_end``), decoded as the empty text.
    very long text or a chunk without spaces: linear in its length; nothing is cut.
    repeated rows: each is encoded.  Empty table: no rows.
    a column whose name clashes with an added one is refused by ``ValueError``.
Models must be of the merge type, without normalisation rules, as the model in use is.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from meanline.llm.text import pieces

SPACE = "▁"
#: Chunks kept encoded in a worker, at most: some 100 MB.
REMEMBERED = 500_000
_LONGEST_REMEMBERED = 64
#: A chunk that ends in a letter and punctuation.
_MARKED = re.compile("(.*[A-Za-zÀ-ÖØ-öø-ÿ])([.,!?;:]+)", re.S)
_CROSSING = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ][.,!?;:]")
_CHUNK = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n")


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("meanline-each-byte", _each_byte)


class Remembered(dict):
    """A dictionary of bounded size: when full, the entries not asked for since the last turn go."""

    def __init__(self, make, most: int = REMEMBERED) -> None:
        self._make, self._most, self._older = make, most // 2, {}

    def __missing__(self, key):
        value = self._older.get(key)
        if value is None:
            value = self._make(key)
        if isinstance(key, str) and len(key) > _LONGEST_REMEMBERED:
            return value
        if len(self) >= self._most:
            self._older = dict(self)
            self.clear()
        self[key] = value
        return value


class PrefixTable:
    """One model, ready to encode and decode."""

    def __init__(self, model: bytes) -> None:
        reader = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.end_id = reader.eos_id()
        self._text: list[str] = []
        self._byte: dict[int, int] = {}
        self._silent = set()
        self._rank: dict[str, tuple[float, int]] = {}
        for i in range(reader.get_piece_size()):
            piece = reader.id_to_piece(i)
            self._text.append(piece)
            if reader.is_byte(i):
                self._byte[i] = int(piece[3:5], 16)
            elif reader.is_control(i):
                self._silent.add(i)
            elif not reader.is_unknown(i):
                self._rank[piece] = (-reader.get_score(i), i)
        self._unknown_text = " ⁇ "
        self._unknown = reader.unk_id()
        self._special = {self._unknown, *self._byte, *self._silent}
        self._of_byte = {value: i for i, value in self._byte.items()}
        self._characters = {p for p in self._rank if len(p) == 1}
        self._cuts_marks = not any(map(_CROSSING.search, self._rank))  # no piece holds a letter and then a mark
        self._compatible = Remembered(self._merges_to, REMEMBERED)
        matches = ahocorasick.Automaton()
        for piece, (_, i) in self._rank.items():
            if len(piece) == 1 or self.merged(piece) == [piece]:
                matches.add_word(piece, (len(piece), i))
        matches.make_automaton()
        self._matches = matches
        self.chunk = Remembered(self._chunk)

    def merged(self, text: str) -> list[str]:
        """The characters of ``text`` merged by rank, the leftmost of equal pairs first."""
        parts = list(text)
        while len(parts) > 1:
            ranked = [
                (self._rank[both][0], i) for i in range(len(parts) - 1) if (both := parts[i] + parts[i + 1]) in self._rank
            ]
            if not ranked:
                break
            at = min(ranked)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _merges_to(self, pair: int) -> bool:
        left, right = self._text[pair >> 20], self._text[pair & 0xFFFFF]
        return self.merged(left + right) == [left, right]

    def _known(self, text: str) -> list[int]:
        """Ids of a text made of characters of the model, by the prefix table."""
        last, size = [-1] * len(text) + [-2], [0] * len(text)  # last[-1] stands before the first character
        compatible = self._compatible
        for end, (length, token) in self._matches.iter(text):
            if last[end] == -1:
                before = last[end - length]
                if before == -2 or before >= 0 and compatible[before << 20 | token]:
                    last[end], size[end] = token, length
        ids, at = [], len(text) - 1
        while at >= 0:
            ids.append(last[at])
            at -= size[at]
        return ids[::-1]

    def _ids(self, chunk: str) -> list[int]:
        if self._characters.issuperset(chunk):
            return self._known(chunk)
        ids, known = [], []
        for character in chunk:
            if character in self._rank:
                known.append(character)
                continue
            if known:
                ids += self._known("".join(known))
                known = []
            ids += (self._of_byte[b] for b in character.encode())
        return ids + self._known("".join(known)) if known else ids

    def _chunk(self, chunk: str) -> tuple[str, str]:
        """A chunk's ids in decimal and what they decode to, with spaces as ``SPACE``: most often the chunk itself."""
        if self._cuts_marks and (parts := _MARKED.fullmatch(chunk)):
            word, marks = self.chunk[parts[1]], self.chunk[parts[2]]
            decimal, surface = f"{word[0]} {marks[0]}", word[1] + marks[1]
        else:
            ids = self._ids(chunk)
            decimal, surface = " ".join(map(str, ids)), self._surface(ids).replace(" ", SPACE)
        return decimal, chunk if surface == chunk else surface

    def chunks(self, text: str | None) -> list[tuple[str, str]]:
        """The encoded chunks of a whole text."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        return list(map(self.chunk.__getitem__, _CHUNK.findall(marked)))

    def encode(self, text: str | None, add_end: bool = True) -> list[int]:
        ids = [int(i) for chunk in self.chunks(text) for i in chunk[0].split()]
        return [*ids, self.end_id] if add_end else ids

    def _surface(self, ids: Iterable[int]) -> str:
        if not self._special.intersection(ids):
            return "".join([self._text[i] for i in ids]).replace(SPACE, " ")
        out, waiting = [], bytearray()
        for i in ids:
            if i in self._byte:
                waiting.append(self._byte[i])
                continue
            if waiting:
                out.append(waiting.decode("utf-8", "meanline-each-byte"))
                waiting = bytearray()
            if i == self._unknown:
                out.append(self._unknown_text)
            elif i not in self._silent:
                out.append(self._text[i].replace(SPACE, " "))
        out.append(waiting.decode("utf-8", "meanline-each-byte"))
        return "".join(out)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of any ids; the space put before the first piece goes."""
        ids = [i for i in ids if i not in self._silent]
        text = self._surface(ids)
        return text[1:] if ids and self._text[ids[0]].startswith(SPACE) else text


_TABLES: dict[str, PrefixTable] = {}


def _table(model: bytes) -> PrefixTable:
    """One table for each model and worker."""
    name = hashlib.sha256(model).hexdigest()
    if name not in _TABLES:
        _TABLES[name] = PrefixTable(model)
    return _TABLES[name]


def _model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _added(df: DataFrame, fields: list[T.StructField]) -> T.StructType:
    clash = {f.name for f in fields} & set(df.columns)
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)} first")
    return T.StructType([*df.schema.fields, *fields])


def encode(df: DataFrame, model_path: str, *, text: str = "text", add_end: bool = True) -> DataFrame:
    """``df`` with the column ``ids`` (array<int>): the token ids of each whole text."""
    model = _model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model)
        for batch, _ in pieces(batches, text):
            ids = pa.array([table.encode(t, add_end) for t in batch.column(text).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, "ids"])

    return df.mapInArrow(run, _added(df, [T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, model_path: str, *, ids: str = "ids") -> DataFrame:
    """``df`` with the column ``decoded``: the text of each array of ids; null ids decode to the empty text."""
    model = _model(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model)
        for batch in batches:
            texts = pa.array([table.decode(i or ()) for i in batch.column(ids).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, "decoded"])

    return df.mapInArrow(run, _added(df, [T.StructField("decoded", T.StringType())]))


def digests(df: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row's encoding and its decoding.

    Ids and decoded text of a chunk are those of ``encode`` and ``decode``; they are only joined here,
    so a frequent chunk is neither encoded nor decoded again.
    """
    model = _model(model_path)
    kind = df.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model)
        end = str(table.end_id)
        for batch, _ in pieces(batches):
            counts, ids, texts = [], [], []
            for text in batch.column("text").to_pylist():
                chunks = table.chunks(text)
                joined = " ".join([*(c[0] for c in chunks), end])
                counts.append(joined.count(" ") + 1)
                ids.append(hashlib.sha256(joined.encode()).hexdigest())
                decoded = "".join([c[1] for c in chunks])[1:].replace(SPACE, " ")
                texts.append(hashlib.sha256(decoded.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return df.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )
