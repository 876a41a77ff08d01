"""Language identification and quality by held-out accuracy, exact inference and small cases."""

import itertools

import numpy as np
import pyarrow as pa

from indexloom.llm import language, quality

SF = "/root/testdata/sf0.01"
SF_LARGE = "/root/testdata/sf0.1"


def test_marginals_like_enumeration():
    rng = np.random.default_rng(1)
    bounds, n_labels = np.array([0, 4, 4, 5, 8]), 3
    scores, moves, start = rng.standard_normal((8, n_labels)), rng.standard_normal((n_labels, n_labels)), rng.standard_normal(n_labels)
    got = language.marginals(scores, bounds, moves, start)
    for a, b in itertools.pairwise(bounds):
        want = np.zeros((b - a, n_labels))
        for path in itertools.product(range(n_labels), repeat=int(b - a)):
            if path:
                w = np.exp(start[path[0]] + sum(scores[a + t, y] for t, y in enumerate(path)) + sum(moves[x, y] for x, y in itertools.pairwise(path)))
                for t, y in enumerate(path):
                    want[t, y] += w
        if b > a:
            assert np.allclose(got[a:b], want / want.sum(axis=1, keepdims=True))


def test_blocks_change_nothing():
    rng = np.random.default_rng(3)
    bounds = np.array([0, 0, 1, 8, 30, 33, 33])
    scores, moves, start = rng.standard_normal((33, 4)), rng.standard_normal((4, 4)), rng.standard_normal(4)
    whole = language.marginals(scores, bounds, moves, start, 100)
    for block in (1, 2, 3, 7):
        assert np.allclose(language.marginals(scores, bounds, moves, start, block), whole)


def test_gradients_like_differences():
    """Of the log-likelihood by enumeration, for emissions, moves and the start."""
    rng = np.random.default_rng(4)
    bounds, truth = np.array([0, 4, 5, 8]), np.array([0, 2, 1, 1, 2, 0, 0, 1])
    params = [rng.standard_normal((8, 3)), 2 * rng.standard_normal((3, 3)), rng.standard_normal(3)]

    def likelihood():
        scores, moves, start = params
        total = 0.0
        for a, b in itertools.pairwise(bounds):
            value = lambda path: start[path[0]] + sum(scores[a + t, y] for t, y in enumerate(path)) + sum(moves[x, y] for x, y in itertools.pairwise(path))  # noqa: B023, E731
            total += value(truth[a:b]) - np.log(sum(np.exp(value(p)) for p in itertools.product(range(3), repeat=int(b - a))))
        return total

    for p, g in zip(params, language.gradients(params[0], truth, bounds, params[1], params[2]), strict=True):
        for at in np.ndindex(p.shape):
            p[at] += 1e-5
            up = likelihood()
            p[at] -= 2e-5
            assert abs((up - likelihood()) / 2e-5 - g[at]) < 1e-6
            p[at] += 1e-5


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF_LARGE}/documents.parquet")
    rows = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(rows) > 1000
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.99


def test_switched_words_get_their_language(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(language.sample_pieces(docs))
    by = {r["lang"]: r["text"].split()[:30] for r in docs.where("length(text) > 400 AND doc_id < 200").collect()}
    words = by["en"] + by["es"]
    data = np.frombuffer(" ".join(words).lower().encode(), np.uint8)
    from indexloom.llm import common

    starts, lengths, _ = common.word_spans(data, np.array([0, len(data)]))
    post = language.marginals(language.emissions(model, data, starts, lengths), np.array([0, len(starts)]), model.moves, model.start)
    said = [model.labels[i] for i in post.argmax(axis=1)]
    assert np.mean([x == y for x, y in zip(said, ["en"] * 30 + ["es"] * 30, strict=True)]) > 0.9


def test_language_cases(spark):
    schema = "doc_id long, text string, lang string, score string"
    rows = [(i, "the house and the dog " * 5, "aa", "x") for i in range(40)] + [(100 + i, "der hund und das haus " * 5, "bb", "x") for i in range(40)]
    rows += [(200, None, "aa", "x"), (201, "", None, "x"), (202, "12 !! ²", "bb", "x"), (None, "und der hund", None, None), (203, "the dog " * 30_000, None, None)]
    df = spark.createDataFrame(rows, schema)
    got = {r["doc_id"]: r for r in language.identify(df).collect()}
    assert [got[i]["lang_pred"] for i in (200, 201, 202)] == ["und"] * 3 and got[200]["score"] == 0
    assert got[None]["lang_pred"] == "bb" and got[203]["lang_pred"] == "aa" and 0.5 < got[203]["score"] <= 1
    assert len(got) == 85
    assert language.identify(df.limit(0)).collect() == []
    unlabelled = language.identify(spark.createDataFrame([(1, "abc", None, None)], schema)).collect()
    assert unlabelled[0]["lang_pred"] == "und"


def test_text_features_ignore_neighbours():
    texts = ["A b\nc, c!", "", None, "x" * 5000 + " 1$ 1$", "one\none\ntwo"]
    together = quality.text_features(pa.array(texts))
    alone = np.concatenate([quality.text_features(pa.array([t], pa.string())) for t in texts])
    assert np.array_equal(together, alone)
    f = dict(zip(quality.FEATURES, together[4], strict=True))
    assert abs(f["repeated_lines"] - 1 / 3) < 1e-6 and abs(f["distinct_words"] - 2 / 3) < 1e-6


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.uniform(-1, 1, (4000, 3)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = quality.train(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    logit = np.full(1, model.intercept)
    for j, (e, t) in enumerate(zip(model.edges, model.tables, strict=True)):
        logit += t[sum(x[0, j] >= v for v in e)]
    for i, j, a, b, t in model.pairs:
        logit += t[sum(x[0, i] >= v for v in a), sum(x[0, j] >= v for v in b)]
    assert np.allclose(model.logit(x[:1]), logit)


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF_LARGE}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.classify(spark, docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 300
    assert np.mean([r["quality"] == r["predicted"] for r in rows]) > 0.97


def test_quality_cases(spark):
    df = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "a b c", 1), (None, "x", 1)], "doc_id long, text string, x int")
    none = spark.createDataFrame([(1, None), (3, 7)], "doc_id long, quality int")
    got = quality.classify(spark, df, none).collect()
    assert len(got) == 4 and {r["score"] for r in got} == {0.5}
    assert quality.classify(spark, df.limit(0), none).collect() == []


def test_repeated_rows_score_alike(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    twice = docs.unionByName(docs)
    for rows in (quality.classify(spark, twice, labels).collect(), language.identify(twice).collect()):
        assert len(rows) == 2 * docs.count() and len({tuple(r) for r in rows}) == docs.count()


def test_quality_takes_no_more_than_its_sample(spark, monkeypatch):
    """At the bound labels are ordered by a hash of doc_id, then by doc_id and label, so ties don't change the model."""
    monkeypatch.setattr(quality, "MAX_ROWS", 50)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    one, two = (sorted(map(tuple, quality.classify(spark, docs.repartition(n), labels.unionByName(labels).repartition(n)).collect())) for n in (1, 5))
    assert one == two and len({r[2] for r in one}) > 1
