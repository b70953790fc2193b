"""Ordinal toxicity: held-out accuracy, ordered grades and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from featuremart.llm import queries, toxicity
from tests.conftest import SF_CHECK

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("doc_id % 2 = 0")
    return toxicity.fit(docs, labels)


def test_held_out_rows(spark, model):
    # about one toxic label in twenty is on a text without any toxic word (label noise)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("doc_id % 2 = 1")
    got = toxicity.score(docs.join(labels, "doc_id"), model) \
        .groupBy("toxic").agg(F.avg(F.col("tox_rejected").cast("int")).alias("r")).collect()
    rate = {r.toxic: r.r for r in got}
    assert rate[1] >= 0.92 and rate[0] <= 0.003, rate


def test_thresholds_are_ordered_and_severity_grows(model):
    assert np.all(np.diff(model.thetas) > 0)
    word = next(w for w, i in model.terms.items() if model.weights[i] > 0 and w[-1] != '*')
    clean, some, many = (p.sum() for p in model.exceed(
        ["plain words " * 40, "plain words " * 40 + word, f"plain {word} " * 40]))
    assert clean < some < many


def test_query(spark):
    got = queries.op1_toxicity(spark, SF_CHECK).toPandas()
    assert len(got) == 1000 and got.severity.between(0, toxicity.GRADES).all()
    lab = spark.read.parquet(f"{SF_CHECK}/labels.parquet").toPandas().merge(got, on="doc_id")
    assert lab[lab.toxic == 1].rejected.mean() > 0.7 and lab[lab.toxic == 0].rejected.mean() < 0.02


def test_odd_rows(spark, model):
    rows = [(None, None, 1), (1, "", 2), (1, "", 2), (2, "Stupid trash idiot! " * 9000, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tox_severity int")
    out = toxicity.score(df, model)
    assert out.columns[:3] == df.columns
    got = out.collect()
    assert [r["tox_rejected"] for r in got] == [False, False, False, True]
    labels = spark.createDataFrame([(1, 0), (None, 1)], "doc_id long, toxic int")
    assert toxicity.keep_clean(df, labels).count() == 4          # one class only: all stay
    assert toxicity.keep_clean(df.limit(0), labels.limit(0)).count() == 0
    assert toxicity.keep_clean(df, labels).columns == df.columns


def test_scores_by_hand(spark, model):
    """Term counts, features, links and severity written out for every document."""
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text")
    for r in toxicity.score(docs, model).collect():
        words = toxicity.tokens(r.text)
        z = 0.0
        n_terms = len(model.terms)
        for term, i in model.terms.items():
            n = sum(w.startswith(term[:-1]) if term[-1] == "*" else w == term for w in words)
            if n:
                z += model.weights[i] + model.weights[n_terms + i] * np.log1p(n) + \
                    model.weights[2 * n_terms + i] * np.log1p(1000.0 * n / len(words))
        p = [1 / (1 + np.exp(t - z)) for t in model.thetas]
        assert r.tox_severity == pytest.approx(sum(p), abs=1e-9)
        assert r.tox_grade == sum(x >= 0.5 for x in p) and r.tox_rejected == (r.tox_severity >= model.threshold)


def test_fit_finds_the_links_that_made_the_grades():
    """Grades drawn from known weights and thresholds: the fitted cumulative links give their shares back."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 3))
    true_w, true_t = np.array([2.0, -1.0, 0.0]), np.arange(toxicity.GRADES) * 1.5
    latent = x @ true_w + rng.logistic(size=4000)
    grade = (latent[:, None] > true_t).sum(1)
    w, t = toxicity.fit_ordinal(x, grade)
    assert np.allclose(w, true_w, atol=0.25) and np.allclose(t, true_t, atol=0.25) and np.all(np.diff(t) > 0)
