import zlib

import numpy as np

from clinsift.llm.quality import fit, keep_good, rank_quality, text_features, train

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_scores(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in rank_quality(docs, labels).collect()}
    assert len(got) == docs.count()
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(got[d].predicted, y) for d, y in truth.items() if d in got and got[d].held_out]
    assert np.mean([p == y for p, y in held]) > 0.95
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_held_out_labels_and_other_columns_change_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.selectExpr(
        "doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - quality else quality end quality"
    )
    read = lambda df: sorted((r.doc_id, r.score) for r in df.collect())
    plain = read(rank_quality(docs, labels))
    assert plain == read(rank_quality(docs.selectExpr("doc_id", "text", "'x' lang", "1 score"), flipped))


def test_no_labels_nulls_and_repeats(spark):
    docs = spark.createDataFrame(
        [(1, None, 5), (2, "", 5), (2, "", 5), (3, "x " * 100_000, 5), (None, "word", 5)], "doc_id long, text string, x int"
    )
    none = spark.createDataFrame([(1, None), (77, 1)], "doc_id long, quality int")
    rows = rank_quality(docs, none).collect()
    assert [r.score for r in rows] == [0.5] * 5
    assert keep_good(docs, none).columns == docs.columns and keep_good(docs, none).count() == 5
    assert rank_quality(docs.limit(0), none).count() == 0


def test_pairs_order_the_documents():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (500, 4)), rng.normal(-1, 1, (400, 4))
    model = fit(good, bad, (1.0, 1.0), pairs=5000)
    assert (model.score(good) >= 0.3).mean() > 0.95 and (model.score(bad) < 0.3).mean() > 0.95
    assert len(text_features("")) == len(text_features("A b.\nC!"))


def test_all_labelled_documents_and_all_their_pairs_count(spark):
    rng = np.random.default_rng(3)
    for n_good, n_bad, gap in ((400, 90, 1.0), (150, 260, 0.2), (30, 30, 4.0), (11_000, 40, 0.5)):
        x = np.concatenate((rng.normal(gap, 1, (n_good, 5)), rng.normal(0, 1, (n_bad, 5)))).astype(np.float32)
        x[0], x[-1] = 60, x[0]  # far off, and twice under both labels
        y = [1] * n_good + [0] * n_bad
        ids = [d for d in range(5 * len(x)) if zlib.crc32(str(d).encode()) % 5][: len(x)]
        described = spark.createDataFrame(
            [(d, v.tolist()) for d, v in zip(ids, x, strict=True)], "doc_id long, x array<float>"
        )
        labels = spark.createDataFrame(list(zip(ids, y, strict=True)), "doc_id long, quality int")
        got = train(described.repartition(7), labels)
        want = fit(x[:n_good], x[n_good:])
        assert np.allclose(got.weights, want.weights, atol=2e-5), abs(got.weights - want.weights).max()
        assert np.allclose(got.score(x), want.score(x), atol=2e-5)
        again = train(described.repartition(2), labels)
        assert np.array_equal(got.weights, again.weights) and got.level == again.level


def test_fit_uses_every_pair(spark):
    rng = np.random.default_rng(4)
    good, bad = rng.normal(0.5, 1, (60, 3)), rng.normal(0, 1, (50, 3))
    want = fit(good, bad, pairs=1 << 20)
    assert np.allclose(fit(good, bad, pairs=70).weights, want.weights, atol=1e-9)
    z = (np.concatenate((good, bad)) - want.mean) / want.scale
    diff = (z[:60, None] - z[None, 60:]).reshape(-1, 3)
    p = 1 / (1 + np.exp(diff @ want.weights))
    assert np.abs(diff.T @ p / len(diff) - 1e-3 * want.weights).max() < 1e-6
