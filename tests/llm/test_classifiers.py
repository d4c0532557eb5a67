import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.llm import lang_id, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def many(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def network(many):
    return lang_id.fit(many)


def test_windows_hold_every_byte_gram():
    for n in (0, 1, 3, 255, 256, 257, 509, 510, 5000):
        data = bytes(np.random.default_rng(n).integers(1, 256, n, dtype=np.uint8))
        parts, lengths = lang_id.windows(data)
        seen = {bytes(w[i : i + 4]) for w in parts for i in range(lang_id.WINDOW - 3)}
        assert {data[i : i + 4] for i in range(n - 3)} <= seen
        assert (lengths >= min(n, 4)).all() and lengths.max() <= lang_id.WINDOW


def test_pair_tables_are_the_convolution(network):
    x = np.random.default_rng(1).integers(0, 256, (3, lang_id.WINDOW)).astype(np.uint8)
    for w in lang_id.WIDTHS:
        r = network._responses(x, w)
        for t in (0, 7, r.shape[1] - 1):
            expected = sum(network.tables[w][k][x[:, t + k]] for k in range(w))
            assert np.allclose(r[:, t], expected, atol=1e-4)
        assert np.allclose(lang_id._pooled(r), r.max(axis=1))


def test_held_out_accuracy_and_contract(many, network):
    rows = lang_id.predict(many, network).join(many.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == many.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out and r.text]
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97


def test_held_out_labels_teach_nothing(many, network):
    """Wrong labels of held-out rows, other sources and other partitions leave the model as it is."""
    wrong = many.withColumn("lang", F.when(lang_id.fit_fold(), F.col("lang")).otherwise(F.lit("xx"))).repartition(5)
    again = lang_id.fit(wrong)
    assert again.languages == network.languages and np.allclose(again.dense, network.dense)


def test_odd_texts(made, nothing, network):
    rows = lang_id.predict(made.withColumn("lang_pred", F.lit("clash")), network).collect()
    assert len(rows) == made.count()
    unknown = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert unknown == {3, 4, 5, 6} and all(r.score == 0 for r in rows if r.doc_id in unknown)
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert lang_id.predict(nothing, network).collect() == []
    kept = lang_id.readable(made, network, least=0.0)
    assert kept.columns == made.columns and not {r.doc_id for r in kept.collect()} & unknown


def test_without_labels_all_is_unknown(made, nothing):
    model = lang_id.fit(nothing.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in lang_id.predict(made, model).collect()} == {"und"}


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_toxic_documents_that_were_not_trained_on(spark):
    """Fit on one half of the ids, judge the other half."""
    many, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    chain = toxicity.fit(many, labels.where(half))
    rows = toxicity.predict(many, chain).join(labels.where(~half), "doc_id").collect()
    least = chain.thresholds[1]
    hit = [r.p_toxic >= least for r in rows if r.toxic == 1]
    wrong = [r.p_toxic >= least for r in rows if r.toxic == 0]
    assert np.mean(hit) > 0.85 and np.mean(wrong) < 0.015, (np.mean(hit), np.mean(wrong))


def test_later_models_use_earlier_probabilities():
    """The second label is the first one turned around; the words tell of the first only in part."""
    rng = np.random.default_rng(1)
    texts, first = [], rng.integers(0, 2, 400)
    for y in first:
        words = [f"w{i}" for i in rng.integers(0, 30, 12)] + (["yes"] * 3 if y else ["no"] * 3)
        texts.append(" ".join(words))
    found = [toxicity.features(t) for t in texts]
    start = np.concatenate([[0], np.cumsum([len(a) for a, _ in found])])
    x = toxicity.Rows(start, np.concatenate([a for a, _ in found]), np.concatenate([v for _, v in found]))
    chain = toxicity.fit_chain(x, np.column_stack([first, 1 - first]), np.arange(400) % 3, ["a", "b"])
    assert chain.models[1].chained[0] < -0.5
    p = np.array([chain.probabilities(t) for t in texts])
    assert ((p[:, 0] > 0.5) == first).mean() > 0.95 and ((p[:, 1] > 0.5) != first).mean() > 0.95


def test_odd_texts_and_labels(spark, made, nothing, labels):
    chain = toxicity.fit(made, labels.limit(0))
    assert {tuple(r)[1:] for r in toxicity.predict(made, chain).collect()} == {(0.0, 0.0)}
    some = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (7, 0, None), (None, 1, 1), (99, 0, 1)], "doc_id long, quality int, toxic int")
    chain = toxicity.fit(made, some)
    rows = toxicity.predict(made.withColumn("p_toxic", F.lit("clash")), chain).collect()
    assert len(rows) == made.count() and all(tuple(r)[1:] == (0.0, 0.0) for r in rows if r.doc_id in (3, 4, 5))
    assert toxicity.predict(nothing, chain).collect() == []
    assert toxicity.flagged(made, chain, least=0.0).count() == made.count()
