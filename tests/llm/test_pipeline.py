"""The corpus pipeline, stage by stage, against plain versions of the stages."""

import hashlib

import brute
import duckdb
import pytest
import sentencepiece

import corpus_pipeline
from meanline.llm import mixing, quality
from meanline.llm.catalog import model_path


@pytest.fixture(scope="module")
def results(spark, small):
    docs, out = spark.read.parquet(f"{small}/documents.parquet"), []
    out.append(docs.toPandas())
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
        docs = spark.createDataFrame(docs.toPandas(), docs.schema)
        out.append(docs.toPandas())
    return out


def texts(frame):
    return dict(zip(frame.doc_id.tolist(), frame.text.tolist(), strict=True))


def test_quality_stage(spark, small, results):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rules = quality.fit(docs, spark.read.parquet(f"{small}/labels.parquet"))
    features = {"symbols_per_word": lambda c: c[2] / max(c[0], 1), "distinct_word_share": lambda c: c[5] / max(c[0], 1),
                "words": lambda c: float(c[0]), "repeated_word_share": lambda c: c[4] / max(c[0], 1),
                "chars_per_word": lambda c: c[1] / max(c[0], 1)}
    if any(c.feature not in features for rule in rules.rules for c in rule):
        pytest.skip("the list uses a feature that the plain version lacks")

    def kept(text):
        c = brute.quality_counts(text)
        holds = lambda k: (features[k.feature](c) > k.threshold) == k.above
        return c[0] >= 50 and 100 * c[4] <= 50 * c[0] and not any(all(map(holds, rule)) for rule in rules.rules)

    assert set(results[1].doc_id) == {i for i, t in texts(results[0]).items() if kept(t)}


def test_near_duplicate_stage(results):
    want = brute.near_components(texts(results[1]), 5, 80)
    assert sorted(results[2].doc_id) == sorted(i for i, (_, c) in want.items() if c == i)


def test_passage_stage(results):
    before, after = texts(results[2]), texts(results[3])
    flags = brute.repeated_bytes(before)
    assert after == {i: brute.cut_text(t, flags[i]) for i, t in before.items()}
    assert results[3].n_chars.tolist() == [len(t) for t in results[3].text]


def test_mixing_stage(results):
    documents = results[3]
    con = duckdb.connect()
    con.register("documents", documents)
    want = {i: taken // size for i, size, taken in con.execute(f"select doc_id, size, taken from ({mixing.MIX_SQL})").fetchall() if taken}
    assert results[4].doc_id.value_counts().to_dict() == want


def test_token_stage(results):
    library = sentencepiece.SentencePieceProcessor(model_file=model_path())
    held, rows = texts(results[4]), results[5]
    assert len(rows) == len(results[4])
    for row in rows.itertuples():
        ids = library.encode(held[row.doc_id], add_eos=True)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_stages_take_odd_rows_and_empty_tables(spark, small):
    schema = spark.read.parquet(f"{small}/documents.parquet").schema
    rows = [(None, "w " * 60, "en", None, 1), (1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0)]
    rows += [(i, " ".join(f"w{i}x{j}" for j in range(80)), "en", "s", 5) for i in range(10, 20)]
    for some in (rows, []):
        docs = spark.createDataFrame(some, schema)
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = stage(spark, docs, small)
            if name != "token_ids":
                assert docs.columns == columns
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert (docs.count() > 0) == bool(some)
