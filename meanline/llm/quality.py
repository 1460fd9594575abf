"""Quality rules: a decision list learned from labelled documents and applied as Spark conditions.

``text_statistics`` counts words, symbols and repeats of whole texts.  ``learn`` covers the rejected
labels one rule at a time: a rule grows by the threshold with the largest information gain, loses the
conditions that do not hold up on rows set aside, and joins the list while it is precise enough.
``DecisionList.column`` writes the list as one ordered ``when`` chain, so applying it is plain Spark.

Defined results
    null or empty text: all counts 0, so a document without words fails the base rule.
    ties: thresholds and features tie to the first in order; equal rows get equal verdicts.
    repeated rows: each row is judged on its own.  Empty tables: an empty result, an empty list.
    no usable labels (none, or one class only): an empty list, only the base rule rejects.
    null labels are left out; a column whose name clashes with a statistic is refused by ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meanline.llm.text import IN_WORD, Ranges, pieces, shingles

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_distinct_words", "n_lines", "n_upper", "n_digits", "n_marks", "n_bytes",
)
#: Rows of labels a list is learned from, at most; they are drawn by a hash of the id.
SAMPLE_ROWS = 20_000


def _of(characters: str) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[np.frombuffer(characters.encode(), np.uint8)] = True
    return flags


_SYMBOL, _UPPER, _DIGIT = _of("#*$%&|<>"), _of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _of("0123456789")
_MARK = _of("!\"'()+,-./:;=?@[\\]^_`{}~")
_STARTS_CHARACTER = (np.arange(256) & 0xC0) != 0x80


def _later_copies(keys: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """True for entries whose key came up earlier in the same document."""
    order = np.lexsort((keys, documents))
    same = (keys[order][1:] == keys[order][:-1]) & (documents[order][1:] == documents[order][:-1])
    flags = np.zeros(len(keys), bool)
    flags[order[1:][same]] = True
    return flags


def _held_twice(keys: np.ndarray, documents: np.ndarray) -> np.ndarray:
    """True for entries whose key stands twice or more in the document."""
    order = np.lexsort((keys, documents))
    same = (keys[order][1:] == keys[order][:-1]) & (documents[order][1:] == documents[order][:-1])
    flags = np.zeros(len(keys), bool)
    flags[order[1:][same]] = True
    flags[order[:-1][same]] = True
    return flags


def _counts(texts) -> dict[str, np.ndarray]:
    data, n = texts.data, texts.n
    starts, ends, documents = texts.words()
    hashes = Ranges(data)
    words = hashes.hash(starts, ends)
    per = lambda where, flags=None: np.bincount(where if flags is None else where[flags], minlength=n)

    windows, window_documents = shingles(words, documents, 3)
    window_starts = np.flatnonzero(documents[: max(0, len(words) - 2)] == documents[2:])
    repeated = np.zeros(len(words), bool)
    for i in range(3):
        repeated[window_starts[_held_twice(windows, window_documents)] + i] = True

    line_starts = np.unique(np.concatenate([np.flatnonzero(data == 10) + 1, texts.offsets[:-1]]))
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.append(line_starts[1:], len(data)) if len(line_starts) else line_starts
    if len(line_ends):
        closed = data[line_ends - 1] == 10
        line_ends = line_ends - closed
    has_word = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
    line_starts, line_ends = line_starts[has_word], line_ends[has_word]
    line_documents = texts.documents(line_starts)
    again = _later_copies(hashes.hash(line_starts, line_ends), line_documents)
    return {
        "n_words": per(documents),
        "word_chars": texts.totals(IN_WORD[data] & _STARTS_CHARACTER[data]),
        "n_symbols": texts.totals(_SYMBOL[data]),
        "n_dup_lines": per(line_documents, again),
        "n_repeat_words": per(documents, repeated),
        "n_distinct_words": per(documents, ~_later_copies(words, documents)),
        "n_lines": per(line_documents),
        "n_upper": texts.totals(_UPPER[data]),
        "n_digits": texts.totals(_DIGIT[data]),
        "n_marks": texts.totals(_MARK[data]),
        "n_bytes": np.diff(texts.offsets),
    }


def text_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with one bigint column for each name in ``COUNTS``; one pass, no shuffle."""
    clash = set(COUNTS) & set(df.columns)
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)} first")
    schema = T.StructType([*df.schema.fields, *(T.StructField(c, T.LongType()) for c in COUNTS)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, text):
            counts = _counts(texts)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(counts[c].astype(np.int64)) for c in COUNTS)],
                names=[*batch.schema.names, *COUNTS],
            )

    return df.mapInArrow(count, schema)


#: What rules may test, as SQL over the counts: rates, so that long and short texts are alike.
FEATURES = {
    "words": "cast(n_words as double)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "duplicate_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_word_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_word_share": "n_distinct_words / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "upper_share": "n_upper / greatest(n_bytes, 1)",
    "digit_share": "n_digits / greatest(n_bytes, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
}


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        values = table[self.feature]
        return values > self.threshold if self.above else values <= self.threshold

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; a row belongs to the first rule whose conditions all hold."""

    rules: tuple[tuple[Condition, ...], ...] = ()

    def column(self) -> Column:
        """The number of the first rule that holds, counted from 1, or null."""
        chain = None
        for number, rule in enumerate(self.rules, 1):
            test = rule[0].column()
            for condition in rule[1:]:
                test = test & condition.column()
            chain = F.when(test, number) if chain is None else chain.when(test, number)
        return F.lit(None).cast("int") if chain is None else chain


def _both(rule: list[Condition], table: dict[str, np.ndarray], n: int) -> np.ndarray:
    flags = np.ones(n, bool)
    for condition in rule:
        flags &= condition.holds(table)
    return flags


def _best_condition(
    table: dict[str, np.ndarray], bad: np.ndarray, thresholds: dict[str, np.ndarray], left_out: set[tuple[str, bool]]
) -> Condition | None:
    """The threshold of the largest information gain for the bad rows, if there is one."""
    p0, n0 = bad.sum(), (~bad).sum()
    best, best_gain = None, 1e-9
    for feature, cuts in thresholds.items():
        place = np.searchsorted(cuts, table[feature])  # value <= cuts[i] exactly where place <= i
        p_below = np.cumsum(np.bincount(place[bad], minlength=len(cuts) + 1))[:-1]
        n_below = np.cumsum(np.bincount(place[~bad], minlength=len(cuts) + 1))[:-1]
        for above in (False, True):
            if (feature, above) in left_out:
                continue
            p, n = (p0 - p_below, n0 - n_below) if above else (p_below, n_below)
            purity = np.log2(np.maximum(p, 1e-12) / np.maximum(p + n, 1e-12))
            gain = np.where(p > 0, p * (purity - np.log2(p0 / (p0 + n0))), 0)
            if len(gain) and gain.max() > best_gain:
                best, best_gain = Condition(feature, above, float(cuts[gain.argmax()])), gain.max()
    return best


def _grow(
    table: dict[str, np.ndarray], bad: np.ndarray, thresholds: dict[str, np.ndarray], failed: set[tuple[str, bool]]
) -> list[Condition]:
    """Add the best threshold until no good row is covered or nothing is gained; none of ``failed`` comes first."""
    rule: list[Condition] = []
    covered = np.ones(len(bad), bool)
    while (covered & bad).any() and (covered & ~bad).any():
        condition = _best_condition(
            {k: v[covered] for k, v in table.items()}, bad[covered], thresholds, set() if rule else failed
        )
        if condition is None:
            break
        rule.append(condition)
        covered &= condition.holds(table)
    return rule


def learn(
    table: dict[str, np.ndarray], bad: np.ndarray, *, least_precision: float = 0.97, least_rows: int = 5,
    cuts: int = 64, most_rules: int = 32,
) -> DecisionList:
    """Rules for the rows where ``bad`` holds.

    Every third bad and every third good row is set aside for pruning: a rule keeps the first conditions
    under which the precision on those rows, corrected after Laplace, is highest.  A rule must cover
    ``least_rows`` bad rows and be right for ``least_precision`` of all rows it covers.  A rule that
    fails is dropped, and the search goes on without its first feature and direction in first place.
    """
    n = len(bad)
    aside = np.zeros(n, bool)
    for part in (bad, ~bad):
        aside[np.flatnonzero(part)[2::3]] = True
    left = np.ones(n, bool)
    rules: list[tuple[Condition, ...]] = []
    failed: set[tuple[str, bool]] = set()
    while len(rules) < most_rules and (left & bad).sum() >= least_rows:
        grow, prune = left & ~aside, left & aside
        part = {k: v[grow] for k, v in table.items()}
        thresholds = {}
        for feature, values in part.items():
            distinct = np.unique(np.quantile(values, np.linspace(0, 1, cuts + 1))) if len(values) else values
            thresholds[feature] = (distinct[1:] + distinct[:-1]) / 2
        rule = _grow(part, bad[grow], thresholds, failed)
        if not rule:
            break

        def worth(conditions: list[Condition], prune=prune) -> float:
            covered = _both(conditions, table, n) & prune
            return ((covered & bad).sum() + 1) / (covered.sum() + 2)

        rule = rule[: 1 + int(np.argmax([worth(rule[:i]) for i in range(1, len(rule) + 1)]))]
        covered = _both(rule, table, n) & left
        right = (covered & bad).sum()
        if right < least_rows or right < least_precision * covered.sum():
            failed.add((rule[0].feature, rule[0].above))
            continue
        rules.append(tuple(rule))
        failed = set()
        left &= ~covered
    return DecisionList(tuple(rules))


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, **options) -> DecisionList:
    """Learn the list from ``labels`` (doc_id, quality 0/1) of ``documents`` (doc_id, text).

    At most ``sample_rows`` labelled rows are used, those with the smallest hash of their id.  Rows that
    the base rule rejects teach nothing that it does not do already and are left out.
    """
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("quality")]
    chosen = (
        labels.where("quality is not null and doc_id is not null").select("doc_id", "quality")
        .orderBy(*order).limit(sample_rows)
    )
    # the sample's bound is what makes the broadcast safe
    counted = text_statistics(documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    rows = (
        counted.where(~base_failed()).select("doc_id", "quality", *(F.expr(sql).alias(name) for name, sql in FEATURES.items()))
        .orderBy(*order, *FEATURES).limit(sample_rows).collect()
    )
    table = {name: np.array([row[name] for row in rows], float) for name in FEATURES}
    return learn(table, np.array([row["quality"] == 0 for row in rows], bool), **options)


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of the words in repeated three-word windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(documents: DataFrame, rules: DecisionList) -> DataFrame:
    """``documents`` with their counts, ``base_failed``, the number of the ``rule`` that rejects, and ``kept``."""
    counted = text_statistics(documents)
    failed = base_failed()
    return (
        counted.withColumn("base_failed", failed)
        .withColumn("rule", rules.column())
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )
