"""The distributed minimum covariance determinant against a plain one with many starts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogflow.llm import quality

SHARE = 0.75


def spread():
    return SHARE / quality._chi2_cdf(quality.chi2_quantile(SHARE, quality.P), quality.P + 2)


def scatter_of(x):
    d = x - x.mean(0)
    return spread() * d.T @ d / len(x) + np.diag(np.square(quality.FLOORS))


def distances(x, mean, scatter):
    return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(scatter), x - mean)


def plain_mcd(x, rng, starts=60):
    """Random starts of seven rows, steps to the end, the least determinant."""
    h, best = int(np.ceil(SHARE * len(x))), None
    for _ in range(starts):
        sub = x[rng.choice(len(x), quality.P + 1, replace=False)]
        mean, scatter, last = sub.mean(0), scatter_of(sub), np.inf
        while True:
            near = x[np.argsort(distances(x, mean, scatter), kind="stable")[:h]]
            mean, scatter = near.mean(0), scatter_of(near)
            det = np.linalg.slogdet(scatter)[1]
            if det > last - 1e-9:
                break
            last = det
        if best is None or det < best[2]:
            best = mean, scatter, det
    return best


@pytest.mark.parametrize("kind", ["clean", "far", "cluster", "flat"])
def test_against_a_plain_run(spark, kind):
    rng = np.random.default_rng({"clean": 1, "far": 2, "cluster": 3, "flat": 4}[kind])
    mix = rng.normal(0, 1, (quality.P, quality.P))
    x = rng.normal(0, 1, (600, quality.P)) @ mix
    bad = np.zeros(600, bool)
    if kind == "far":
        bad[:100] = True
        x[:100] = rng.normal(0, 1, (100, quality.P)) * 30 + 40
    if kind == "cluster":  # a fifth of the rows close together: all rows and the quartiles are pulled towards it
        bad[:120] = True
        x[:120] = 25 + rng.normal(0, 0.05, (120, quality.P))
    if kind == "flat":  # most values of two statistics are 0
        x[:, 2:4] = np.where(rng.random((600, 2)) < 0.8, 0, np.abs(x[:, 2:4]))
    mean, scatter, det = plain_mcd(x, rng)
    columns = [f"x{i}" for i in range(quality.P)]
    df = spark.createDataFrame([("c", *map(float, r)) for r in x], "cell string, " + ", ".join(f"{c} double" for c in columns)).repartition(4)
    quartiles = [F.percentile_approx(c, [0.25, 0.5, 0.75], 10000).alias(f"m{i}") for i, c in enumerate(columns)]
    sized = df.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *quartiles)
    got = quality._least_determinant(df, quality._starts(df, sized), SHARE, spread(), 20).first()
    # a step takes whole bins of distance, so up to a few rows more than the plain run
    assert got["logdet"] < det + 0.15
    d = distances(x, mean, scatter)
    inverse = np.zeros((quality.P, quality.P))
    for k, (i, j) in enumerate(quality._PAIRS):
        inverse[i, j] = inverse[j, i] = got["inv"][k]
    gap = x - np.array(got["mean"])
    mine = np.einsum("ij,jk,ik->i", gap, inverse, gap)
    assert np.corrcoef(np.log1p(d), np.log1p(mine))[0, 1] > 0.99
    limit = quality.chi2_quantile(0.999999, quality.P)
    assert (mine[bad] > limit).all() and ((mine > limit) == (d > limit))[(d < 0.7 * limit) | (d > 1.4 * limit)].all()


def test_determinant_does_not_rise(spark):
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(0, 1, (300, quality.P)), rng.normal(8, 1, (80, quality.P))])
    columns = [f"x{i}" for i in range(quality.P)]
    df = spark.createDataFrame([(str(i % 2), *map(float, r)) for i, r in enumerate(x)], "cell string, " + ", ".join(f"{c} double" for c in columns))
    sized = df.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(c, [0.25, 0.5, 0.75], 10000).alias(f"m{i}") for i, c in enumerate(columns)])
    starts = quality._starts(df, sized)
    assert starts.count() == 8
    few = {r["cell"]: r["logdet"] for r in quality._least_determinant(df, starts, SHARE, spread(), 0).collect()}
    many = {r["cell"]: r["logdet"] for r in quality._least_determinant(df, starts, SHARE, spread(), 20).collect()}
    assert set(few) == set(many) == {"0", "1"} and all(many[c] <= few[c] for c in few)
