import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from threadlake.llm import quality
from threadlake.llm.quality import co_train, fit_quality, keep_good, score_documents

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"


def good(rng):
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(rng.randint(20, 80))).capitalize() + "."


def bad(rng):
    word = rng.choice(["SPAM!!", "x", "buy###"])
    return " ".join([word] * rng.randint(10, 60))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        fine = i % 4 != 0
        text = good(rng) if fine else bad(rng)
        rows.append((i, text, rng.choice(["en", "de"]), "clean" if fine and rng.random() < 0.9 else "mixed", len(text), "s"))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, int(fine)))
    return spark.createDataFrame(rows, SCHEMA), labels


def test_held_out_accuracy(spark, corpus):
    df, labels = corpus
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    model = fit_quality(df, marks)
    got = {r.doc_id: r for r in score_documents(df, model).collect()}
    held_out = set(range(400)) - {i for i, _ in labels}
    right = sum(got[i].keep == (i % 4 != 0) for i in held_out)
    assert right / len(held_out) > 0.98
    assert all(0 <= r.score <= 1 and 0 <= r.text_score <= 1 and 0 <= r.meta_score <= 1 for r in got.values())
    kept = keep_good(df, model)
    assert kept.schema == df.schema
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.keep}


def test_views_teach_each_other():
    """With two labels a class in one view, the pseudo-labels of the other view help."""
    rng = np.random.default_rng(0)
    truth = rng.integers(0, 2, 600)
    text = (truth[:, None] * 2 + rng.normal(size=(600, 3))).astype(np.float32)
    meta = (truth[:, None] * 6 + rng.normal(size=(600, 2))).astype(np.float32)
    labels = np.full(600, -1)
    labels[:60] = truth[:60]
    alone = co_train(text, meta, labels, rounds=0)
    taught = co_train(text, meta, labels, rounds=4)

    def accuracy(model):
        return ((model.text.logit(text[60:]) > 0) == truth[60:]).mean()

    assert accuracy(taught) >= accuracy(alone)
    assert ((taught.scores(text, meta)[2] > 0.5) == truth).mean() > 0.98


def test_all_unlabelled_rows_take_part(spark, corpus, monkeypatch):
    """Every unlabelled row is seen in each round, repeated and null ids too."""
    df, labels = corpus
    marks = spark.createDataFrame(labels[:120], "doc_id long, quality int")
    seen, train = [], quality.co_train

    def watched(text, meta, marked, **rest):
        total = rest.get("total")
        seen.append(total(lambda views, luck: np.array([float(len(luck))]))[0] if total else (marked < 0).sum())
        return train(text, meta, marked, **rest)

    monkeypatch.setattr(quality, "co_train", watched)
    more = df.where("doc_id > 380").withColumn("doc_id", F.lit(None).cast("long"))
    copies = df.where("doc_id > 390")
    unlabelled = 280 + 19 + 9
    many = df.union(more).union(copies)
    for _ in range(4):
        many, unlabelled = many.union(copies.crossJoin(spark.range(125)).drop("id")), unlabelled + 9 * 125
    model = fit_quality(many, marks)
    assert seen == [unlabelled]
    assert model is not None


def test_odd_rows_and_no_labels(spark, corpus):
    df, labels = corpus
    odd = spark.createDataFrame(
        [(None, None, None, None, None, None), (0, "", "en", "clean", 0, "s"), (0, "y" * 200_000, None, "mixed", -5, "s")], SCHEMA
    )
    none = spark.createDataFrame([(0, None), (None, 1), (3, 7), (1, 1), (1, 0)], "doc_id long, quality int")
    model = fit_quality(df, none)
    assert model is None
    assert {r.score for r in score_documents(odd, model).collect()} == {1.0}
    assert keep_good(odd, None).count() == 3
    marks = spark.createDataFrame([*labels, *labels, (None, 1), (5, None), (6, 0), (6, 1)], "doc_id long, quality int")
    model = fit_quality(df.union(odd), marks)
    assert score_documents(odd, model).count() == 3
    assert score_documents(odd.limit(0), model).count() == 0
