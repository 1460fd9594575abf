"""Phrase collocations: the longest windows are counted, ROLLUP adds up all shorter phrases.

Texts are cut into pieces at punctuation and pieces into words.  Every word starts one window: itself and
the next words of its piece, in columns of their own, padded with an empty word where the piece ends.
Only windows are counted; as every occurrence of a shorter phrase is the beginning of exactly one window,
ROLLUP over the columns gives the counts of all shorter phrases, of single words, and of all words.

Tasks count windows some million words at a time, and the counts are dealt out by their first two words.
There the end of a window that is too rare to be a candidate is replaced by padding (a rare window keeps
its place in the sums of its shorter beginnings), so that few rows are left to roll up.  Two words that
begin many windows are dealt out by the third word too; a sample finds them, which matters for the
distribution of the work and not for the result.

A phrase of ``a`` occurrences cut into two parts of ``l`` and ``r`` occurrences scores
``floor(scale * a * a / (l * r))``; its lowest-scoring cut counts.  A phrase inside a longer one that
accounts for most of its occurrences is left out.

Defined results
    null or empty text, texts of punctuation only: no words.  Null lang: ``und``.
    ties: between cuts the shorter first part; between phrases by occurrences, then in UTF-8 byte order.
    repeated rows: each counts.  Very long texts: handled whole.  Empty tables: an empty result.
    other columns: not used, whatever their names.
    arithmetic: decimals of 38 digits, exact up to 10**16 occurrences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meanline.llm.text import Texts, mix, pieces
from meanline.sources.storage import scratch, shared_table

#: Words, and bytes of text, whose windows a task counts together.
CHUNK_WORDS, CHUNK_BYTES = 2_000_000, 64 << 20
_ROWS = 50_000
#: One document in so many is looked at for beginnings that hold more than one window in ``HOT_SHARE``.
SAMPLE_SHARE, HOT_SHARE = 64, 1000
#: Buckets that windows are dealt to by their beginnings, in each task's hands many.
BUCKETS = 1 << 16

_ENDS = np.isin(np.arange(256), np.frombuffer(b".,;:!?\n\x0b\x0c\r", np.uint8))
_IN_WORD = ~_ENDS & ~np.isin(np.arange(256), [0x20, 0x09])
_LOWER = np.arange(256, dtype=np.uint8) + 32 * ((np.arange(256) >= 65) & (np.arange(256) <= 90)).astype(np.uint8)


def _words(texts: Texts) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words, whether the next one is in the same piece, and their documents."""
    starts, ends, documents = texts.words(_IN_WORD)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    held = _LOWER[texts.data[_IN_WORD[texts.data]]]
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(held))
    piece = np.cumsum(_ENDS[texts.data])[starts] if len(starts) else starts
    follows = np.zeros(len(starts), bool)
    follows[:-1] = (piece[1:] == piece[:-1]) & (documents[1:] == documents[:-1])
    return words, follows, documents


def _counted(words: pa.Array, follows: np.ndarray, langs: np.ndarray, longest: int) -> tuple[list[np.ndarray], pa.Array, np.ndarray]:
    """Columns (lang, then word numbers with 0 for padding) of the different windows, the words, the counts."""
    coded = words.dictionary_encode()
    columns = [langs, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1]
    whole = follows
    for ahead in range(1, longest):
        column = np.zeros(len(langs), np.int64)
        column[:-ahead] = np.where(whole[:-ahead], columns[1][ahead:], 0)
        columns.append(column)
        whole = whole.copy()
        whole[:-ahead] &= follows[ahead:]
        whole[-ahead:] = False
    key, room, steps = columns[0].astype(np.int64), int(langs.max()) + 1, []
    base = len(coded.dictionary) + 1
    for column in columns[1:]:
        if room * base >= 1 << 62:  # number the keys so far anew, to make room
            known, key = np.unique(key, return_inverse=True)
            steps.append(known)
            room = len(known)
        else:
            steps.append(None)
        key, room = key * base + column, room * base
    found, counts = np.unique(key, return_counts=True)
    parts = []
    for known in reversed(steps):
        parts.append(found % base)
        found = found // base
        found = found if known is None else known[found]
    return [found, *reversed(parts)], pa.concat_arrays([pa.array([""]), coded.dictionary]), counts


def _beginnings(words: pa.Array, langs: list[str], columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of lang and the first two words of each window, and one of the third word."""
    crc = np.fromiter(map(zlib.crc32, words.cast(pa.binary()).to_pylist()), np.uint64, len(words))
    of_lang = np.fromiter((zlib.crc32(x.encode()) for x in langs), np.uint64, len(langs))
    first = mix(of_lang[columns[0]] << np.uint64(32) ^ crc[columns[1]])
    third = crc[columns[3]] if len(columns) > 3 else np.zeros(len(first), np.uint64)
    return mix(first ^ crc[columns[2]]), third


def windows(
    df: DataFrame, longest: int, text: str = "text", lang: str = "lang", hot: Sequence[int] = ()
) -> DataFrame:
    """bucket, window, n: the different windows of some million words each.

    A window is its first two words, a tab, the others, a line break and the lang; words hold none of
    these.  Windows of one beginning share a bucket, but for those whose beginning's hash is in ``hot``:
    they are dealt to several by the third word, and their buckets are negative.
    """
    names = ["bucket", "window", "n"]
    salted = np.array(hot, np.int64).view(np.uint64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, weight, number = [], 0, 0, {}

        def flush() -> Iterator[pa.RecordBatch]:
            words, follows, langs = (list(x) for x in zip(*held, strict=True))
            held.clear()
            columns, dictionary, counts = _counted(
                pa.concat_arrays(words), np.concatenate(follows), np.concatenate(langs), longest
            )
            del words, follows, langs
            spoken = list(number)
            first, third = _beginnings(dictionary, spoken, columns)
            bucket = (first % np.uint64(BUCKETS)).astype(np.int32)
            split = np.isin(first, salted)
            bucket[split] = -1 - (mix(first ^ third)[split] % np.uint64(BUCKETS)).astype(np.int32)
            spoken = pa.array(spoken, pa.string())
            for at in range(0, len(counts), _ROWS):
                which, *words = (pa.array(c[at : at + _ROWS]) for c in columns)
                texts = [dictionary.take(c) for c in words]
                begin = pc.binary_join_element_wise(texts[0], texts[1], " ")
                rest = pc.binary_join_element_wise(*texts[2:], " ") if longest > 2 else pa.array([""] * len(begin))
                window = pc.binary_join_element_wise(pc.binary_join_element_wise(begin, rest, "\t"), spoken.take(which), "\n")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[at : at + _ROWS]), window, pa.array(counts[at : at + _ROWS])], names=names
                )

        for batch, texts in pieces(batches, "text"):
            words, follows, documents = _words(texts)
            if not len(words):
                continue
            of = np.array([number.setdefault(x, len(number)) for x in batch.column("lang").to_pylist()], np.int64)
            held.append((words, follows, of[documents]))
            size, weight = size + len(words), weight + len(texts.data)
            if size >= CHUNK_WORDS or weight >= CHUNK_BYTES:
                yield from flush()
                size = weight = 0
        if held:
            yield from flush()

    named = df.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    return named.mapInArrow(count, "bucket int, window string, n bigint")


def hot_beginnings(df: DataFrame, longest: int, text: str = "text", lang: str = "lang") -> list[int]:
    """Hashes of the beginnings of many windows in a sample of the documents, fewer than ``HOT_SHARE``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, "text"):
            words, follows, documents = _words(texts)
            if not len(words):
                continue
            number: dict[str, int] = {}
            of = np.array([number.setdefault(x, len(number)) for x in batch.column("lang").to_pylist()], np.int64)
            columns, dictionary, counts = _counted(words, follows, of[documents], longest)
            first, _ = _beginnings(dictionary, list(number), columns)
            found, n = np.unique(first, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["beginning", "n"])

    some = df.where(F.pmod(F.xxhash64(text), F.lit(SAMPLE_SHARE)) == 0)
    named = some.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    counts = shared_table(
        named.mapInArrow(hashed, "beginning bigint, n bigint").groupBy("beginning").agg(F.sum("n").alias("n")), "beginnings"
    )
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return [r["beginning"] for r in counts.where(F.col("n") * HOT_SHARE > F.lit(total)).collect()]


def frequent_windows(df: DataFrame, longest: int, min_count: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, w1 to w<longest>, n: all windows, with padding in place of the words after which they are too rare."""
    hot = hot_beginnings(df, longest, text, lang) if longest > 2 else []
    summed = (
        windows(df, longest, text, lang, hot).repartition("bucket").groupBy("bucket", "window").agg(F.sum("n").alias("n"))
    )
    words = F.substring_index("window", "\n", 1)
    parts = summed.select(
        "bucket", "n", F.substring_index(words, "\t", 1).alias("first"), F.substring_index(words, "\t", -1).alias("rest"),
        F.expr("substring(window, locate('\n', window) + 1)").alias("lang"),
    )
    further = [f"w{i + 1}" for i in range(2, longest)]
    if longest == 3:
        parts = parts.withColumnRenamed("rest", "w3")
    else:
        split = F.split("rest", " ")
        parts = parts.select("*", *(split[i].alias(name) for i, name in enumerate(further)))
    keys = ["first", "lang", "bucket"]
    kept = []
    for i, name in enumerate(further):
        whole = i == len(further) - 1
        total = F.col("n") if whole else F.sum("n").over(Window.partitionBy(*keys, *further[: i + 1]))
        kept.append(F.when(total >= min_count, F.col(name)).otherwise("").alias(name))
    # only a part of a salted beginning is here, so its second word stays
    both = F.sum("n").over(Window.partitionBy(*keys)) if further else F.col("n")
    second = F.when((F.col("bucket") < 0) | (both >= min_count), F.substring_index("first", " ", -1)).otherwise("")
    names = ["w1", "w2", *further]
    shortened = parts.select("lang", F.substring_index("first", " ", 1).alias("w1"), second.alias("w2"), *kept, "n")
    return shortened.groupBy("lang", *names).agg(F.sum("n").alias("n"))


def _rolled(rows: DataFrame, names: list[str]) -> DataFrame:
    """lang, words, f: occurrences of every beginning of the windows of ``rows``, also of the empty one."""
    counted = rows.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    depth = F.lit(len(names)) - F.bit_count("level").cast("int")  # -1 for the total of all langs
    last = F.element_at(F.array(F.lit("-"), *names), depth + 1)
    wanted = (depth == 0) | (depth > 0) & (last != "")  # else the beginning ends in padding
    return counted.where(wanted).select("lang", F.slice(F.array(*names), F.lit(1), depth).alias("words"), "f")


def phrase_counts(df: DataFrame, longest: int, min_count: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, words (an array), f: phrases of up to ``longest`` words that occur ``min_count`` times or more.

    The row without words has the number of all words of its lang.
    """
    names = [f"w{i + 1}" for i in range(longest)]
    counted = shared_table(frequent_windows(df, longest, min_count, text, lang), "windows")
    # windows left with one word have no beginnings of two
    rolled = _rolled(counted.where("w2 != ''"), names).unionByName(_rolled(counted.where("w2 = ''"), names[:1]))
    return rolled.groupBy("lang", "words").agg(F.sum("f").alias("f")).where((F.size("words") == 0) | (F.col("f") >= min_count))


def _phrase(words: Column) -> Column:
    return F.array_join(words, " ")


def collocations(
    df: DataFrame, text: str = "text", lang: str = "lang", *, longest: int = 3, min_count: int = 10, top: int = 2000,
    scale: int = 1_000_000, inside_percent: int = 50,
) -> DataFrame:
    """Each lang's ``top`` phrases of 2 to ``longest`` words: lang, rank, phrase, a, l, r, n, score.

    Phrases inside a longer candidate with ``inside_percent`` of their occurrences or more are left out.
    """
    if longest < 2 or min_count < 1:
        raise ValueError("a collocation has two words or more and occurs")
    with scratch(df.sparkSession) as keep:
        counts = shared_table(
            phrase_counts(df, longest, min_count, text, lang).withColumn("phrase", _phrase(F.col("words"))), "phrases"
        )
        size = F.size("words")
        candidates = counts.where(size >= 2).withColumnRenamed("f", "a")
        cut = F.col("k")
        parts = candidates.select(
            "lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
        ).select(
            "lang", "phrase", "a", "k", _phrase(F.slice("words", F.lit(1), cut)).alias("first"),
            _phrase(F.slice("words", cut + 1, size - cut)).alias("rest"),
        )
        left = counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
        right = counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
        # a whole division: decimals of 38 digits, cut down, not rounded
        score = F.expr(
            f"cast(a as decimal(19, 0)) * cast(a as decimal(19, 0)) * cast({int(scale)} as decimal(10, 0)) "
            "div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"
        )
        lowest = (
            parts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
            .groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
        )
        starts = F.flatten(F.transform(
            F.sequence(F.lit(2), size - 1),
            lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: _phrase(F.slice("words", i, m))),
        ))
        longer = (
            candidates.where(size >= 3).select("lang", "a", F.explode(starts).alias("phrase"))
            .groupBy("lang", "phrase").agg(F.max("a").alias("inside"))
        )
        totals = counts.where(size == 0).select("lang", F.col("f").alias("n"))
        order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
        ranked = (
            lowest.join(longer, ["lang", "phrase"], "left")
            .where(F.col("inside").isNull() | (F.col("inside") * 100 < F.col("a") * inside_percent))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
            .where(F.col("rank") <= top)
        )
        return keep(ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations")


COLLOCATIONS_SQL = r"""
with d as (select coalesce(lang, 'und') as lang, row_number() over () as doc,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
p as (select lang, doc, unnest(parts) as piece, unnest(range(len(parts))) as i
  from (select lang, doc, regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]') as parts from d)),
w as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]'), lambda x: x <> '') as words from p),
g as (select lang, unnest(list_transform(range(1, len(words) - m + 2), lambda i: words[i : i + m - 1])) as words
  from w, (select unnest([1, 2, 3]) as m) where len(words) >= m),
n as (select lang, count(*)::bigint as n from g where len(words) = 1 group by lang),
f as materialized (select lang, words, count(*) as f from g group by lang, words having count(*) >= 10),
c as (select lang, words, f as a from f where len(words) > 1),
k as (select lang, words, a, unnest(range(1, len(words))) as k from c),
s as (select k.lang, k.words, k.a, k.k, x.f as l, y.f as r,
  (1000000::hugeint * k.a * k.a // (x.f::hugeint * y.f))::bigint as score
  from k join f x on x.lang = k.lang and x.words = k.words[1 : k.k]
  join f y on y.lang = k.lang and y.words = k.words[k.k + 1 :]),
b as (select * from s qualify row_number() over (partition by lang, words order by score, k) = 1),
o as (select lang, unnest([words[1:2], words[2:3]]) as words, a from c where len(words) = 3),
m as (select lang, words, max(a) as inside from o group by lang, words),
t as (select b.lang, array_to_string(b.words, ' ') as phrase, b.a, b.l, b.r, n.n, b.score from b
  join n using (lang) left join m using (lang, words) where m.inside is null or 100 * m.inside < 50 * b.a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from t qualify row_number() over (partition by lang order by score desc, a desc, phrase) <= 2000
"""
