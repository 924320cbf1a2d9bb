"""The pipeline, stage by stage, against plain Python on a small table."""
import corpus_pipeline
import llm_brute as B
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from restock.llm import bpe, quality_cnn
from restock.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), name))
    return out


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()))


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "byte_bpe"]


def test_stages_against_plain_python(spark, stages):
    docs, one, two, three, four, five = stages
    for df in (one, two, three, four):
        assert df.columns == docs.columns
    net = quality_cnn.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    score = lambda t: net.score(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0]
    assert rows_of(one) == [(d, t) for d, t in rows_of(docs) if score(t) >= 0.3]
    a = rows_of(one)
    assert rows_of(two) == [(d, w[3]) for (d, _), w in zip(a, B.deduplicated_lines(a, 3))]
    b = rows_of(two)
    group = B.components([(d, B.simhash(t)) for d, t in b])
    assert rows_of(three) == [x for x, g in zip(b, group) if x[0] == g]
    c = rows_of(three)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert rows_of(four) == [x for x, h in zip(c, B.contamination([t for _, t in c], items)) if not h[1]]
    lib = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    got = {r.doc_id: r for r in five.collect()}
    assert len(got) == four.count()
    for d, t in rows_of(four):
        assert got[d].tokens == lib.encode_ordinary(t) and got[d].decoded_sha256 == B.sha(t)
    assert {r.n_chars for r in two.where("n_chars <> length(text)").collect()} == set()


def test_run_equals_the_stages(spark, stages):
    got = sorted((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == sorted((r.doc_id, r.ids_sha256) for r in stages[-1].collect())


def test_stages_on_hard_rows(spark):
    """Nulls, repeated rows, extra columns that clash, and no rows at all."""
    rows = [(i, t, None, "s", 0, "r", "u", 1, 2, "k") for i, t in enumerate(B.texts(3, 40))]
    rows += [rows[20], rows[20], (None, "a text without an id", "en", "s", 1, "r", "u", 1, 2, "k"), (None, None) + (None,) * 8]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string, uid string, _k long, key long, kept string"
    full = spark.createDataFrame(rows, schema)
    for docs in (full, full.where("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            n = docs.count()
            docs = materialize(stage(spark, docs, SF), name)
            assert docs.columns == full.columns and docs.count() <= n
            if name == "line_dedup":
                assert docs.count() == n
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
