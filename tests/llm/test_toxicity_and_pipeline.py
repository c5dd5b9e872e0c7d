"""Held-out accuracy of the toxicity machine; the pipeline's stages and contract."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from pulsegrid.llm import queries, toxicity
from tests.conftest import SF_SMALL
from tests.helpers import duck, rows

DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def machine(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    return docs, labels, toxicity.train(docs, queries.learnable(labels))


def test_held_out_accuracy(machine):
    docs, labels, model = machine
    held = labels.filter(F.crc32(F.col("doc_id").cast("string")) % 3 == 1)
    got = toxicity.toxicity(docs.join(held, "doc_id"), model).select("toxic", "predicted").toPandas()
    assert got[got.toxic == 1].predicted.mean() > 0.9
    assert got[got.toxic == 0].predicted.mean() < 0.005


def test_gaps_and_insertions(machine):
    _, _, model = machine
    s = toxicity.Scorer(model)
    clean = s.texts(["the thing was there and then", "with the other"])
    for text in ("you id*iot there", "what an i d i o t", "stu-pid thing", "1diot"):
        assert s.texts([text])[0, 0] > clean.max()


def test_scores_take_odd_rows(spark, machine):
    _, _, model = machine
    rows_ = [(None, None), (1, ""), (2, " \n"), (3, "x" * 200_000), (4, "idiot " * 50_000), (4, "a"), (4, "a")]
    df = spark.createDataFrame(rows_, "doc_id long, text string").withColumn("score", F.lit("s"))
    got = toxicity.toxicity(df, model)
    assert got.columns == ["doc_id", "text", "score", "predicted"] and got.count() == 7
    assert got.filter("score is null or score < 0 or score > 1").count() == 0
    assert got.filter("predicted = 1").count() == 1


def test_without_labels_nothing_is_toxic(spark):
    docs = spark.createDataFrame([(1, "idiot")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert model is None and toxicity.toxicity(docs, model).first().predicted == 0


def test_kernel_is_the_weighted_sum_over_shared_subsequences():
    def brute(w):
        from itertools import combinations
        x, out = toxicity._letters(w), {}
        for at in combinations(range(len(x)), 3):
            u = tuple(x[i] for i in at)
            out[u] = out.get(u, 0) + toxicity.DECAY ** (at[2] - at[0] + 1)
        return out
    words = ["moron", "morxon", "banana", "ab"]
    got = toxicity.kernel(words, words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            p, q = brute(a), brute(b)
            want = sum(v * q.get(u, 0) for u, v in p.items()) / np.sqrt(
                sum(v * v for v in p.values()) * sum(v * v for v in q.values()))
            assert got[i, j] == pytest.approx(want, rel=1e-4)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_sql(spark, name):
    got, want = queries.QUERIES[name](spark, SF_SMALL).toPandas(), duck(SF_SMALL).execute(queries.ORACLES[name]).df()
    assert rows(got) == rows(want)


def test_every_operator_is_registered():
    names = E.queries()
    assert all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11)) and "pipeline" in names


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "simhash_dedup", "mixing", "best_fit_packing"]
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        assert [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        if name == "line_dedup":
            assert out.count() == docs.count()
        if name == "simhash_dedup":
            parts = queries.QUERIES["op2_simhash_dedup"](spark, SF_SMALL).select("component_id").distinct()
            assert out.count() == parts.count()
    packed = P.run(spark, SF_SMALL)
    assert packed.agg(F.max(F.col("offset") + F.col("length"))).first()[0] <= 4096
