"""Quality rules, near-duplicates, repeated passages and token ids against plain versions."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from meanline.llm import near, passages, pieces_bpe, quality
from meanline.llm.catalog import QUERIES, model_path
from meanline.llm.components import components
from meanline.llm.filters import maybe_in
from meanline.llm.text import Ranges, Texts

SCHEMA = "doc_id bigint, text string"
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, "Two words"), (6, "Two words"), (None, "no id at all"),
    (7, "é🙂\x00 " * 3000), (8, "x" * 70_000), (9, "\n".join(["same line"] * 50)),
]


@pytest.fixture(scope="module")
def texts(spark, small):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_equal_ranges_have_equal_hashes():
    texts = Texts(pa.array(["abc abd", None, "xabc", ""]))
    hashes = Ranges(texts.data)
    one, two, other = hashes.hash(np.array([0, 8, 4]), np.array([3, 11, 7]))
    assert one == two != other
    starts, ends, documents = texts.words()
    assert [(bytes(texts.data[s:e]), d) for s, e, d in zip(starts, ends, documents, strict=True)] == [
        (b"abc", 0), (b"abd", 0), (b"xabc", 2),
    ]


def test_quality_counts(spark, small, texts):
    rows = quality.text_statistics(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")).collect()
    assert all(tuple(r[c] for c in quality.COUNTS[:6]) == brute.quality_counts(r.text) for r in rows)
    odd = quality.text_statistics(frame(spark, ODD)).collect()
    assert len(odd) == len(ODD)
    assert all(tuple(r[c] for c in quality.COUNTS[:6]) == brute.quality_counts(r.text) for r in odd)


def test_quality_rules_are_learned_and_hold_on_other_rows(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rules = quality.fit(documents, labels.where("doc_id % 2 = 0"))
    assert rules.rules
    judged = quality.judge(documents, rules).join(labels.where("doc_id % 2 = 1"), "doc_id").where("not base_failed").collect()
    right = sum((r.quality == 1) == r.kept for r in judged)
    assert right >= 0.97 * len(judged)
    assert not [r for r in judged if r.quality == 1 and not r.kept]


def test_quality_without_labels_keeps_what_passes_the_base_rule(spark):
    documents = frame(spark, [*ODD, (20, " ".join(f"w{i}" for i in range(60)))])
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    rules = quality.fit(documents, none)
    assert rules == quality.DecisionList()
    kept = {r.doc_id for r in quality.judge(documents, rules).where("kept").collect()}
    assert kept == {20}
    one_class = spark.createDataFrame([(20, 1, 0), (4, None, 0)], "doc_id bigint, quality int, toxic int")
    assert quality.fit(documents, one_class) == quality.DecisionList()
    assert quality.judge(frame(spark, []), rules).count() == 0
    with pytest.raises(ValueError, match="n_words"):
        quality.judge(documents.withColumn("n_words", documents.doc_id), rules)


def test_learned_list_prefers_the_separating_threshold():
    x = np.arange(300.0)
    rules = quality.learn({"words": x, "digit_share": np.zeros(300)}, x > 199.5)
    assert [[(c.feature, c.above) for c in rule] for rule in rules.rules] == [[("words", True)]]
    assert 195 < rules.rules[0][0].threshold < 205


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(spark, small, texts, width, percent):
    got = near.near_duplicates(spark.read.parquet(f"{small}/documents.parquet"), shingle_words=width, percent=percent).collect()
    want = brute.near_components(texts, width, percent)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {
        i: (n, c, i == c) for i, (n, c) in want.items()
    }


@pytest.mark.parametrize("repeated", [False, True])
def test_signatures_are_stored_once_unless_a_doc_id_has_several_sets(spark, monkeypatch, repeated):
    tables, store = [], near.shared_table

    def named(df, name):
        tables.append((name, df.columns))
        return store(df, name)

    monkeypatch.setattr(near, "shared_table", named)
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "u v w x y z"), (1 if repeated else 4, "k l m n o p")]
    got = sorted((r.doc_id, r.component_id) for r in near.near_duplicates(frame(spark, rows)).collect())
    assert got == sorted((i, 1 if i == 2 else i) for i, _ in rows)
    carrying = [name for name, columns in tables if "signature" in columns]
    assert carrying == ["signed", "copies", *(["nodes"] if repeated else [])]


def test_near_duplicates_of_odd_rows(spark):
    got = near.near_duplicates(frame(spark, ODD), shingle_words=3, percent=85).collect()
    assert len(got) == len(ODD)
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {
        (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (6, 6, True), (None, None, True),
        (7, 7, True), (8, 8, True), (9, 9, True),
    }
    assert near.near_duplicates(frame(spark, [])).count() == 0


def test_a_chain_of_edits_is_one_component_and_a_star_is_not_enough(spark):
    # each text is near the next one only, so no centre is near all of them
    words = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(12):
        edited = list(words)
        for j in range(k * 8):
            edited[(j * 37) % 400] = f"e{j}"
        rows.append((k, " ".join(edited)))
    want = brute.near_components(dict(rows), 3, 85)
    assert len({c for _, c in want.values()}) < 12
    got = near.near_duplicates(frame(spark, rows), shingle_words=3, percent=85).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: c for i, (_, c) in want.items()}


def test_sequential_decisions_keep_pairs_at_the_threshold():
    rng, decisions = random.Random(3), near.least_matches(85, 120)
    lost = 0
    for _ in range(3000):
        matches = [rng.random() < 0.85 for _ in range(120)]
        lost += any(sum(matches[:n]) < m for n, m in decisions)
    assert lost == 0
    low = [rng.random() < 0.5 for _ in range(120)]
    assert any(sum(low[:n]) < m for n, m in decisions)
    assert (1 - 0.85**5) ** near.band_count(85) <= near.MISS


def test_components(spark):
    edges = spark.createDataFrame(
        [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (8, 9), (7, 7), (None, 1), (20, 10), (20, 11), (20, 12)], "a bigint, b bigint"
    )
    assert {(r.node, r.component) for r in components(edges).collect()} == {
        *((i, 1) for i in range(1, 6)), (8, 8), (9, 8), (10, 10), (11, 10), (12, 10), (20, 10),
    }
    assert components(edges.where("a = 7")).count() == 0


def test_filter_loses_nothing(spark):
    rows = spark.range(5000).withColumnRenamed("id", "k")
    wanted = rows.where("k % 7 = 0")
    found = {r.k for r in maybe_in(rows, wanted, "k").collect()}
    rest = {r.k for r in maybe_in(rows, wanted, "k", keep=False).collect()}
    assert {k for k in range(0, 5000, 7)} <= found
    assert found | rest == set(range(5000)) and not found & rest
    assert maybe_in(rows, wanted.where("k < 0"), "k").count() == 0


def passage_rows(spark, rows):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in passages.summarize(frame(spark, rows)).collect()}


def test_repeated_passages(spark, small, texts):
    flags = brute.repeated_bytes(texts)
    got = {r.doc_id: r for r in QUERIES["op3_suffix_array_dedup"](spark, small).collect()}
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in got.items()} == {
        i: brute.passage_row(texts[i], flags[i]) for i in texts
    }


@pytest.mark.parametrize("limit", [2048, 1])
def test_passages_of_periodic_and_edited_texts(spark, monkeypatch, limit):
    monkeypatch.setattr(passages, "TASK_REGIONS", limit)
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefgh ") for _ in range(900))
    rows = [(0, base), (1, "a" * 350), (2, "ab" * 200 + base[100:320]), (3, base[:400] + "é" + base[401:]), (4, "é" * 150)]
    rows += [(10 + k, base[k * 7 : k * 7 + 150] + f"#{k}#" + base[300 : 400 + k]) for k in range(20)]
    rows += [(99, "short"), (100, None), (101, base + base)]
    flags = brute.repeated_bytes(dict(rows))
    assert passage_rows(spark, rows) == {i: brute.passage_row(t, flags[i]) for i, t in rows}
    cut = {r.doc_id: r.text for r in passages.remove_repeats(frame(spark, rows)).collect()}
    assert cut == {i: None if t is None else brute.cut_text(t, flags[i]) for i, t in rows}


def test_a_common_passage_is_no_row_for_each_string(spark):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(130))
    rows = [(i, f"{i:05d}".encode() + passage.encode()) for i in range(300)]
    strings = spark.createDataFrame([(1, i, i % 7 << 16 | 36, data) for i, data in rows], "block bigint, doc_id bigint, place bigint, bytes binary")
    found = passages._compared_one_by_one(strings.coalesce(1), 100).collect()
    assert len(found) < 1000
    got = {(r.doc_id, r.start + k) for r in found for k in range(r.n)}
    seen, want = set(), set()
    for i, data in rows:
        for k in range(36):
            want |= {(i, i % 7 + k)} if data[k : k + 100] in seen else set()
        seen |= {data[k : k + 100] for k in range(36)}
    assert got == want and sum(r.n for r in found) == len(want)


def test_passages_of_odd_rows(spark):
    rows = [*ODD, (None, "y" * 300), (30, "z" * 120 + "q"), (30, "z" * 120 + "q")]
    got = passages.summarize(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {r.n_removed for r in got if r.doc_id is None} == {0}
    assert {r.n_removed for r in got if r.doc_id == 8} == {69_999}
    assert passages.summarize(frame(spark, [])).count() == 0


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=model_path())


def test_prefix_table_gives_the_library_ids(library):
    with open(model_path(), "rb") as file:
        table = pieces_bpe.PrefixTable(file.read())
    rng = random.Random(2)
    parts = list("a b  c ▁\n\t,.é日本🙂\x00<s></s><0x41>12   ") + [library.id_to_piece(rng.randrange(300, 32000)) for _ in range(300)]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        ids = library.encode(text, add_eos=True)
        assert table.encode(text) == ids
        assert table.decode(ids) == library.decode(ids) == "".join(c[1] for c in table.chunks(text))[1:].replace(pieces_bpe.SPACE, " ")
    for _ in range(2000):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(3, 259) for _ in range(rng.randrange(10))]
        assert table.decode(ids) == library.decode(ids)


def test_token_ids_of_documents(spark, small, texts, library):
    import hashlib

    got = {r.doc_id: r for r in QUERIES["op6_sentencepiece"](spark, small).collect()}
    assert len(got) == len(texts)
    for i, text in texts.items():
        ids = library.encode(text or "", add_eos=True)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_encode_and_decode_of_odd_rows(spark, library):
    encoded = pieces_bpe.encode(frame(spark, ODD), model_path())
    rows = pieces_bpe.decode(encoded, model_path()).collect()
    assert len(rows) == len(ODD)
    for row in rows:
        assert row.ids == library.encode(row.text or "", add_eos=True)
        assert row.decoded == (row.text or "")
    assert pieces_bpe.encode(frame(spark, []), model_path()).count() == 0
    with pytest.raises(ValueError, match="ids"):
        pieces_bpe.encode(encoded, model_path())


def test_texts_of_regular_structure_do_not_collide(spark):
    """Thue-Morse strings and their complements are equal under any polynomial modulo 2**64."""
    morse = "".join("ab"[bin(i).count("1") & 1] for i in range(4096))
    other = morse.translate(str.maketrans("ab", "ba"))
    texts = Texts(pa.array([morse, other, morse]))
    hashes = Ranges(texts.data).hash(texts.offsets[:-1], texts.offsets[1:])
    assert hashes[0] == hashes[2] != hashes[1]
    df = frame(spark, [(1, morse), (2, other), (3, f"{morse}\n{other}\n{morse}")])
    assert [r.n_dup_lines for r in quality.text_statistics(df).orderBy("doc_id").collect()] == [0, 0, 1]
    got = {r.doc_id: r.component_id for r in near.near_duplicates(df.where("doc_id < 3"), shingle_words=3, percent=85).collect()}
    assert got == {1: 1, 2: 2}
    flags = brute.repeated_bytes({1: morse, 2: other})
    rows = {r.doc_id: r for r in passages.summarize(df.where("doc_id < 3")).collect()}
    assert {i: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for i, r in rows.items()} == {
        i: brute.passage_row(t, flags[i]) for i, t in ((1, morse), (2, other))
    }


def test_hashes_are_two_polynomials(spark):
    from meanline.llm import text as module

    data = np.random.default_rng(4).integers(0, 256, 5000).astype(np.uint8)
    prime = 2**31 - 1
    for start, end in ((0, 1), (0, 5000), (77, 77), (1234, 4321)):
        halves = [
            sum(((int(module.BYTE[c]) >> shift) & prime) % prime * pow(base, i, prime) for i, c in enumerate(data[start:end].tolist())) % prime
            for base, shift in zip(module._BASES, (0, 32), strict=True)
        ]
        plain = (halves[0] << 31 | halves[1]) + (end - start) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
        assert Ranges(data).hash(np.array([start]), np.array([end]))[0] == module.mix(np.array([plain], np.uint64))[0]
