"""Repeated lines, collocations and vector codes against SQL and plain versions."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from check import compare
from meanline.llm import codebooks, collocations, lines
from meanline.llm.skew import join_totals

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACE = " \t\n\v\f\r"
THUE_MORSE = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))


@pytest.mark.parametrize("name", ["op11_bloom_line_dedup", "op12_rollup_collocations", "op13_orchard_codes"])
def test_queries_give_the_sql_rows(spark, duck, small, name):
    assert compare(spark, duck, name, small) is None


# -- lines


def plain_lines(rows, least, chars=1, keep_first=False):
    """[(text left, lines, dropped)] of [(doc_id, text)]."""
    key = lambda line: line.strip(SPACE).translate(LOWER)
    held, first = defaultdict(set), {}
    for r, (doc, text) in sorted(enumerate(rows), key=lambda x: (x[1][0] is None, x[1][0] or 0)):
        for i, line in enumerate((text or "").split("\n")):
            held[key(line)].add(r)
            first.setdefault(key(line), (doc, text, i))
    out = []
    for doc, text in rows:
        all_lines = (text or "").split("\n")
        gone = [
            len(key(x)) >= max(chars, 1) and len(held[key(x)]) >= least and not (keep_first and first[key(x)] == (doc, text, i))
            for i, x in enumerate(all_lines)
        ]
        out.append(("\n".join(x for x, g in zip(all_lines, gone, strict=True) if not g), len(all_lines), sum(gone)))
    return out


def line_rows():
    draw = random.Random(5)
    stock = ["Home", " home\t", "HOME", "é", "É", "", "   ", "menu | a", "x" * 5000, THUE_MORSE, "\x00nul", "🙂 smile"]
    stock += [THUE_MORSE.translate(str.maketrans("ab", "ba"))]
    rows = [(i, "\n".join(draw.choice(stock + [f"own {i} {k}" for k in range(9)]) for _ in range(draw.randrange(1, 12)))) for i in range(150)]
    return [*rows, (None, "home\nnull id"), (500, None), (501, ""), (502, "\n\n"), (503, "home"), (503, "home"), (504, "long line " * 30_000 + "\nhome\r")]


@pytest.mark.parametrize("bits", [1 << 16, 1 << 22])
@pytest.mark.parametrize(("least", "chars", "keep_first"), [(10, 1, False), (2, 1, True), (3, 5, True), (2, 1, False)])
def test_lines_against_a_plain_version(spark, bits, least, chars, keep_first):
    rows = line_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = lines.drop_repeated_lines(df, min_documents=least, min_chars=chars, keep_first=keep_first, filter_bits=bits)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    want = [(doc, *rest) for (doc, _), rest in zip(rows, plain_lines(rows, least, chars, keep_first), strict=True)]
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_only_suspects_are_shuffled(spark):
    rows = [(i, f"only here {i}\nshared {i % 50}") for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    keyed = df.select(F.unhex(F.md5("text")).alias("doc_key"), "doc_id", "text")
    found = lines.suspects(keyed, lines.seen_twice(df)).collect()
    assert len({(r.doc_id, r.line) for r in found if r.line == 1}) == 1000
    assert sum(r.line == 0 for r in found) < 10


def test_lines_of_an_empty_table_and_of_clashing_columns(spark):
    schema = "doc_id int, n_lines string, row int, dropped int, text string, doc_key int, digest int"
    assert lines.drop_repeated_lines(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "x", 7, 1, "a\nb", 3, 4), (2, None, None, None, "a", None, None)]
    got = lines.drop_repeated_lines(spark.createDataFrame(rows, schema), keep_first=True).orderBy("doc_id")
    assert got.columns == ["doc_id", "row", "dropped", "text", "doc_key", "digest", "n_lines", "n_dropped"]
    assert [tuple(r) for r in got.collect()] == [(1, 7, 1, "a\nb", 3, 4, 2, 0), (2, None, None, "", None, None, 1, 1)]
    with pytest.raises(ValueError, match="repeated"):
        lines.drop_repeated_lines(spark.createDataFrame([], schema), min_documents=1)


def test_join_with_totals_where_one_key_holds_most_rows(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), "id")
    totals = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = join_totals(rows, totals, "k", "n").collect()
    assert len(got) == 5000
    assert Counter(r.n for r in got) == {1: 1667, 3333: 3333}


# -- phrases


def plain_phrases(rows, longest=3, least=10, top=2000, percent=50):
    import re

    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, held in counts.items():
        candidates = {w: a for w, a in held.items() if len(w) > 1 and a >= least}
        inside = Counter()
        for w, a in candidates.items():
            for m in range(2, len(w)):
                for i in range(len(w) - m + 1):
                    inside[w[i : i + m]] = max(inside[w[i : i + m]], a)
        scored = []
        for w, a in candidates.items():
            if inside[w] and 100 * inside[w] >= percent * a:
                continue
            score, _, left, right = min(
                (1_000_000 * a * a // (held[w[:k]] * held[w[k:]]), k, held[w[:k]], held[w[k:]]) for k in range(1, len(w))
            )
            scored.append((-score, -a, " ".join(w).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


@pytest.mark.parametrize(("longest", "least", "top", "percent"), [(3, 10, 2000, 50), (4, 3, 40, 70), (2, 1, 5, 50), (5, 2, 1000, 100)])
def test_phrases_against_a_plain_version(spark, longest, least, top, percent):
    draw = random.Random(11)
    vocabulary = ["New", "york", "CITY", "new", "é", "É", " ", "a\x00b", "𝄞", "～", *(f"w{i}" for i in range(12))]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    ends = ["", ".", ", ", "!\n", ";;", "\t", " \x0b"]
    rows = [
        (draw.choice(["en", "de", None]), " ".join(w + (draw.choice(ends) if draw.random() < 0.2 else "") for w in draw.choices(vocabulary, weights, k=draw.randrange(0, 40))))
        for _ in range(200)
    ]
    rows += [("en", None), ("fr", ""), ("fr", " .,!"), ("en", "new york city " * 3000), (None, "one"), ("xx", "two two")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = collocations.collocations(df, longest=longest, min_count=least, top=top, inside_percent=percent)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(plain_phrases(rows, longest, least, top, percent))


def test_phrases_of_large_counts_are_exact(spark, monkeypatch):
    """Products that pass 64 bits: counts are put in place of counted windows."""
    a, left, right = 3_037_000_507, 3_037_000_511, 9_000_000_001
    rows = [("en", ["x", "y"], a), ("en", ["x"], left), ("en", ["y"], right), ("en", [], 10**13)]
    counted = spark.createDataFrame(rows, "lang string, words array<string>, f bigint")
    monkeypatch.setattr(collocations, "phrase_counts", lambda *a, **k: counted)
    got = collocations.collocations(spark.createDataFrame([], "lang string, text string")).collect()
    assert [tuple(r) for r in got] == [("en", 1, "x y", a, left, right, 10**13, 10**6 * a * a // (left * right))]


def test_phrases_of_empty_tables_and_clashing_columns(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    df = spark.createDataFrame([("en", "a b " * 20, 1, 2, 3)], "lang string, text string, w1 int, words int, piece int")
    assert sorted(map(tuple, collocations.collocations(df).collect())) == sorted(plain_phrases([("en", "a b " * 20)]))


# -- codes


def plain_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    """{vec_id: (code, error)} and the books of [(vec_id, vector)] with ids that do not repeat."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort()
    length = len(kept[0][1])
    cut = [i * length // parts for i in range(parts + 1)]
    books = [[v[cut[p] : cut[p + 1]] for _, v in kept[:entries]] for p in range(parts)]

    def nearest(book, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for _, v in kept:
                groups[nearest(books[p], v[cut[p] : cut[p + 1]])[1]].append(v[cut[p] : cut[p + 1]])
            books[p] = [[sum(x) // len(groups[i]) for x in zip(*groups[i], strict=True)] if i in groups else e for i, e in enumerate(books[p])]
    codes = {}
    for i, v in kept:
        found = [nearest(books[p], v[cut[p] : cut[p + 1]]) for p in range(parts)]
        codes[i] = "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)
    return codes, books


@pytest.mark.parametrize(("length", "n", "entries", "spread"), [(8, 300, 256, 1), (8, 60, 16, 1), (6, 40, 256, 1), (8, 90, 20, 1e4), (8, 90, 20, 1e7), (3, 9, 4, 1)])
def test_codes_against_a_plain_version(spark, length, n, entries, spread):
    draw = random.Random(3)
    rows = [(i * 3 % 1009, [spread * round(draw.gauss(0, 1), 1) for _ in range(length)]) for i in range(n)]
    rows += [(2000, rows[0][1]), (2001, None), (2002, [None] * length), (2003, [float("nan")] * length), (2004, [float("inf")] + [0.0] * (length - 1))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    books = codebooks.fit(df, entries=entries)
    codes, want = plain_codes(rows, entries=entries)
    assert [[list(e) for e in book] for book in books.books] == want
    assert books.sha256 == hashlib.sha256(",".join(str(x) for b in want for e in b for x in e).encode()).hexdigest()
    assert {r.vec_id: (r.code, r.error) for r in codebooks.encode(df, books).collect()} == {
        i: (code, error if error < 1 << 63 else None) for i, (code, error) in codes.items()
    }


def test_search_is_exact_and_saves_distances_on_clustered_vectors():
    draw = np.random.default_rng(1)
    centres = draw.integers(-4000, 4000, (64, 16))
    entries = (centres[draw.integers(0, 64, 256)] + draw.integers(-20, 20, (256, 16))).astype(float)
    entries[200] = entries[7]
    parts = (centres[draw.integers(0, 64, 3000)] + draw.integers(-20, 20, (3000, 16))).astype(float)
    index, squared, computed = codebooks.Orchard(entries).nearest(parts)
    every = ((parts[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (index == every.argmin(axis=1)).all()
    assert (squared == every.min(axis=1)).all()
    assert computed < 0.5 * every.size


def test_codes_of_labels_odd_lengths_and_empty_tables(spark):
    schema = "vec_id bigint, embedding array<float>, label int, code int, v int, row int"
    empty = spark.createDataFrame([], schema)
    assert codebooks.codes_with_totals(empty).count() == 0
    rows = [(None, [0.0] * 4, None, 1, 1, 1), (1, [1.0, 2.0, 3.0, 4.0], None, 1, 1, 1), (1, [1.0, 2.0, 3.0, 4.5], 5, 1, 1, 1), (2, [1.0], 5, 1, 1, 1)]
    df = spark.createDataFrame(rows, schema)
    books = codebooks.fit(df, entries=2)
    assert [len(b) for b in books.books] == [2] * 4
    coded = codebooks.encode(df, books)
    assert coded.columns == ["vec_id", "embedding", "label", "v", "row", "code", "error"]
    assert coded.count() == 3
    got = codebooks.codes_with_totals(df, entries=2).collect()
    totals = Counter()
    for r in got:
        totals[r.label] += r.error
    assert all(r.label_error == totals[r.label] for r in got)
    back = codebooks.decode(coded, books).collect()
    for r in back:
        assert sum((math.floor(1024 * a) - 1024 * b) ** 2 for a, b in zip(r.embedding, r.approximation, strict=True)) == r.error
