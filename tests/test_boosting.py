import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidemark.ml import boosting
from tidemark.ml.boosting import HistogramBoosting, HistogramBoostingModel
from tidemark.ml.splits import grow, predict
from tidemark.session import scratch_path


def frame(spark, x, y):
    rows = [(k, v.tolist(), float(t)) for k, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "key long, values array<double>, label double").withColumn("features", array_to_vector("values"))


def data(n, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 9, n), rng.integers(0, 4, n), rng.integers(0, 30, n)]).astype(float)
    return x, np.round(x[:, 0] * 2 - (x[:, 1] > 1) * 5 + rng.normal(0, 1, n), 3)


def plain(x, y, rounds, depth, rate=0.3, penalty=1.0):
    """Boosting row by row over all values as bins: predictions of the training rows."""
    margin = np.full(len(y), y.mean())
    for _ in range(rounds):
        def walk(rows, level, g):
            best = (1e-9, None)
            for f in range(x.shape[1]) if level < depth else ():
                for cut in np.unique(x[rows, f])[:-1]:
                    left = rows[x[rows, f] <= cut]
                    right = rows[x[rows, f] > cut]
                    gain = g[left].sum() ** 2 / (len(left) + penalty) + g[right].sum() ** 2 / (len(right) + penalty) - g[rows].sum() ** 2 / (len(rows) + penalty)
                    if gain > best[0] + 1e-9:
                        best = (gain, (left, right))
            if best[1] is None:
                margin[rows] += -rate * g[rows].sum() / (len(rows) + penalty)
            else:
                for part in best[1]:
                    walk(part, level + 1, g)
        walk(np.arange(len(y)), 0, margin - y)
    return margin


def predictions(model, df):
    return np.array([r["prediction"] for r in model.transform(df).orderBy("key").collect()])


@pytest.mark.parametrize("rounds,depth", [(1, 1), (1, 3), (5, 2)])
def test_equals_plain_boosting(spark, rounds, depth):
    x, y = data(120)
    df = frame(spark, x, y)
    assert predictions(HistogramBoosting(rounds=rounds, depth=depth).fit(df), df) == pytest.approx(plain(x, y, rounds, depth), abs=1e-6)


def test_many_tasks_and_jobs_give_the_same_model(spark, monkeypatch):
    x, y = data(200)
    df = frame(spark, x, y)
    one = predictions(HistogramBoosting(rounds=7, depth=3).fit(df), df)
    monkeypatch.setattr(boosting, "ROWS_PER_TASK", 60)
    assert predictions(HistogramBoosting(rounds=7, depth=3, roundsPerJob=3).fit(df.repartition(5)), df) == pytest.approx(one, abs=1e-9)


def test_sums_are_sent_in_pieces():
    class Context:
        def getTaskInfos(self):
            return [0, 1]

        def allGather(self, message):
            return [message, message]
    sums = np.arange(2 * 5 * 7, dtype=float).reshape(2, 5, 7)
    assert (boosting.exchanged(sums, Context()) == 2 * sums).all()
    old, boosting.PIECE_BYTES = boosting.PIECE_BYTES, 1
    try:
        assert (boosting.exchanged(sums, Context()) == 2 * sums).all()
    finally:
        boosting.PIECE_BYTES = old


def test_saved_model_predicts_the_same_and_unseen_values_fall_into_the_outer_bins(spark):
    x, y = data(80)
    df = frame(spark, x, y)
    model = HistogramBoosting(rounds=4, depth=2).fit(df)
    path = scratch_path(spark, "test-boosting")
    model.write().overwrite().save(path)
    far = frame(spark, np.array([[-1e9, -5.0, -5.0], [1e9, 99.0, 99.0]]), [0, 0])
    loaded = HistogramBoostingModel.load(path)
    assert predictions(loaded, df).tolist() == predictions(model, df).tolist()
    assert np.isfinite(predictions(loaded, far)).all()


def test_constant_labels_and_no_rows(spark):
    x, _ = data(20)
    df = frame(spark, x, np.full(20, 4.5))
    assert predictions(HistogramBoosting(rounds=3).fit(df), df) == pytest.approx(np.full(20, 4.5))
    with pytest.raises(ValueError, match="no training rows"):
        HistogramBoosting().fit(df.limit(0))


def test_exact_splits_equal_brute_force(spark):
    x, y = data(150)
    df = spark.createDataFrame([(*map(float, v), float(t)) for v, t in zip(x, y)], "a double, b double, c double, label double")
    splits = grow(df, ["a", "b", "c"], "label", 2)

    def best(rows):
        found = []
        for f in range(3):
            values = np.unique(x[rows, f])
            for lo, hi in zip(values[:-1], values[1:]):
                left, right = rows[x[rows, f] <= lo], rows[x[rows, f] > lo]
                found.append((y[left].sum() ** 2 / len(left) + y[right].sum() ** 2 / len(right) - y[rows].sum() ** 2 / len(rows), f, (lo + hi) / 2, left, right))
        return max(found, key=lambda c: (round(c[0], 7), -c[1], -c[2]))
    gain, f, cut, left, right = best(np.arange(150))
    want = [(1, "abc"[f], cut, len(left), len(right))]
    for node, rows in ((2, left), (3, right)):
        _, f, cut, low, high = best(rows)
        want.append((node, "abc"[f], cut, len(low), len(high)))
    assert [(s["node"], s["feature"], s["threshold"], s["n_left"], s["n_right"]) for s in splits] == want
    assert splits[0]["gain"] == pytest.approx(gain)
    sse = df.select(F.sum((F.col("label") - predict(splits, float(y.mean()))) ** 2)).first()[0]
    assert sse == pytest.approx(((y - y.mean()) ** 2).sum() - sum(s["gain"] for s in splits))
