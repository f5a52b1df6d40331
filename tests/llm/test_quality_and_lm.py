import numpy as np
import pytest

from tidemark.llm.lm_scoring import pseudo_likelihood
from tidemark.llm.quality import (
    _Binned,
    _counted,
    _featured,
    _keys,
    _risk,
    _sums_of_risk,
    _values_of,
    cells,
    cut_points,
    estimate_prior,
    fit_quality,
    keep_quality,
    local_sums,
    posterior_by_score,
    quality_scores,
    spark_sums,
    text_statistics,
)
from tidemark.llm.queries import queries

FOLDER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in queries()["op2_quality_classifier"](spark, FOLDER).where("held_out").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    good, bad = (np.array([rows[i].score for i, q in labels.items() if i in rows and q == k]) for k in (1, 0))
    assert np.mean(good[:, None] > bad[None, :]) > 0.98
    assert np.mean(good >= 0.3) > 0.98 and np.mean(bad >= 0.3) < 0.1


def test_labels_of_the_held_out_fold_are_not_read(spark):
    from pyspark.sql import functions as F

    from tidemark.llm.quality import held_out

    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    changed = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = ({r.doc_id: r.score for r in quality_scores(docs, x).collect()} for x in (labels, changed))
    assert first == second


def test_quality_edges(spark, crowded, no_rows):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality_scores(crowded, none).collect()
    assert len(rows) == crowded.count()
    assert {r.doc_id: r.score for r in rows if r.doc_id in (3, 4, 6, 7)} == {3: 0.0, 4: 0.0, 6: 0.0, 7: 0.5}
    odd = spark.createDataFrame([(1, 1), (None, 1), (2, None), (99, 1), (1, 1), (7, 1)], "doc_id long, quality int")
    assert quality_scores(crowded, odd).count() == crowded.count() and quality_scores(no_rows, odd).count() == 0
    assert keep_quality(crowded, none).columns == crowded.columns
    assert not text_statistics(" \n").any() and len(text_statistics("one")) == len(text_statistics("x y z\nx y z"))


def test_prior_and_curve():
    r = np.random.default_rng(1)
    positive, unlabelled = cells(r.normal(3, 1, 4000)), cells(np.concatenate([r.normal(3, 1, 2800), r.normal(-3, 1, 1200)]))
    assert estimate_prior(positive, unlabelled) == pytest.approx(0.7, abs=0.04)
    at, chance = posterior_by_score(positive, unlabelled, 0.7)
    assert (np.diff(chance) >= 0).all() and np.interp(3, at, chance) > 0.9 and np.interp(-3, at, chance) < 0.1
    # few texts: the error makes the prior wide, without any switch
    assert estimate_prior(cells(r.normal(0, 1, 2)), cells(r.normal(0, 1, 2))) == 0.99
    assert estimate_prior(cells(np.empty(0)), cells(np.empty(0))) == 0.99


def test_cells_and_keys_keep_the_order():
    r = np.random.default_rng(4)
    x = np.sort(np.concatenate([r.normal(0, 100, 1000), r.normal(0, 1e-3, 1000), [0.0]]).astype(np.float32))
    keys = _keys(x)
    assert (np.diff(keys) >= 0).all() and np.allclose(_values_of(keys), x, rtol=2**-8, atol=1e-30)


def brute_risk(p, u, w, prior, decay):
    """The non-negative risk by its definition, text by text; and whether the negatives' part is above zero."""
    loss = lambda z: np.log1p(np.exp(-z))
    positive = np.mean([loss(w[r].sum()) for r in p])
    negative = np.mean([loss(-w[r].sum()) for r in u]) - prior * np.mean([loss(-w[r].sum()) for r in p])
    return prior * positive + max(0.0, negative) + decay / 2 * (w @ w), negative


def test_the_direction_is_the_gradient_of_the_risk():
    """From sums over two slices of the unlabelled, against differences of the risk by its definition."""
    r = np.random.default_rng(5)
    x = r.normal(0, 1, (300, len(text_statistics("a")))).astype(np.float32)
    positive, whole = x[:80], x[80:]
    binned = _Binned(cut_points(_counted(whole, whole), 4))
    p, u = binned.columns(positive), binned.columns(whole)
    for scale in (0.01, 0.1):
        w = r.normal(0, scale, binned.size)
        work = _sums_of_risk(binned, [(w, None)])
        part = sum(work(x, np.zeros(len(x), int)) for x in np.array_split(whole, 2))
        negative, slope = _risk(binned.design(positive), w, 0.4, 1e-3, part[1] / part[0], part[2:] / part[0])
        value, wanted = brute_risk(p, u, w, 0.4, 1e-3)
        assert part[0] == len(whole) and negative == pytest.approx(wanted) and wanted > 0
        for k in r.integers(0, binned.size, 8):
            step = np.eye(binned.size)[k] * 1e-4
            change = (brute_risk(p, u, w + step, 0.4, 1e-3)[0] - brute_risk(p, u, w - step, 0.4, 1e-3)[0]) / 2e-4
            assert slope[k] == pytest.approx(change, abs=1e-6)


def test_a_negative_risk_below_zero_is_stepped_out_of():
    p = np.ones((10, 1), np.float32)
    negative, slope = _risk(p, np.array([2.0]), 0.9, 0.0, 0.1, np.array([0.3]))
    assert negative < 0 and slope[0] == pytest.approx(0.9 / (1 + np.exp(-2)) - 0.3)


def test_the_fit_covers_all_unlabelled_texts():
    """A kind of junk that the sample doesn't hold is found all the same, as a fit on the sample alone can't."""
    r = np.random.default_rng(6)
    size = len(text_statistics("a"))
    good = r.normal(0, 1, (9000, size)).astype(np.float32)
    bad = r.normal(0, 1, (900, size)).astype(np.float32)
    bad[:, :3] += 6
    whole = np.concatenate([good[3000:], bad])
    model, blind = fit_quality(good[:3000], whole[:2000], local_sums(whole)), fit_quality(good[:3000], whole[:2000])
    caught, missed = (np.mean(m.score(bad) < 0.3) for m in (model, blind))
    assert caught > 0.6 and caught > missed + 0.3 and np.mean(model.score(good) >= 0.3) > 0.95


def test_sums_in_the_cluster_equal_those_at_hand(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    features = _featured(docs, "doc_id", "text").where("id is not null and not held_out")
    x = np.array([text_statistics(r.text) for r in docs.where("pmod(crc32(cast(doc_id as string)), 5) <> 0").collect()])
    got = spark_sums(features)(_counted)
    assert (got == _counted(x, x)).all()
    key = np.array([r.key for r in features.select("key").collect()])
    assert 0.4 < np.mean(key % 2) < 0.6 and labels.count()


def test_many_rows_of_one_id(spark):
    """A trusted id that many documents share: one row of it is fitted, whatever their number."""
    docs = spark.range(4000).selectExpr("case when id < 3000 then 1 else id end as doc_id", "concat('Good text number ', id % 50, ', of words.') as text")
    labels = spark.createDataFrame([(1, 1), (1, 1), (3001, 1)], "doc_id long, quality int")
    assert quality_scores(docs, labels).count() == 4000 and keep_quality(docs, labels).columns == docs.columns


def test_columns_that_clash(spark):
    docs = spark.createDataFrame([(1, "a b c.", "x", "y", 1.0)], "doc_id long, text string, c0 string, x string, key double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [tuple(r) for r in keep_quality(docs, none).collect()] == [(1, "a b c.", "x", "y", 1.0)]


def test_negatives_are_found_without_negative_labels():
    r = np.random.default_rng(2)
    size = len(text_statistics("a"))
    good, bad = r.normal(0, 1, (9000, size)).astype(np.float32), r.normal(1.5, 1, (3000, size)).astype(np.float32)
    model = fit_quality(good[:3000], np.concatenate([good[3000:6000], bad[:1000]]))
    assert model.prior == pytest.approx(0.75, abs=0.05)
    assert np.mean(model.score(good[6000:]) >= 0.5) > 0.95 and np.mean(model.score(bad[1000:]) >= 0.5) < 0.05


def test_lm_edges(crowded, no_rows):
    rows = pseudo_likelihood(crowded).collect()
    assert len(rows) == crowded.count() and {(r.log_likelihood, r.mean_log_likelihood) for r in rows if r.doc_id in (3, 4, 6)} == {(0.0, None)}
    assert pseudo_likelihood(no_rows).count() == 0
