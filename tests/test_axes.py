import numpy as np
import pytest

from textloom.operators import axes as A
from textloom.operators.reduce import pca


def frame(spark, x):
    return spark.createDataFrame([(i, [float(e) for e in r]) for i, r in enumerate(x)], "id long, v array<double>").repartition(5)


def svd(x, k):
    _, sizes, right = np.linalg.svd(x - x.mean(0), full_matrices=False)
    axes = right[:k].T
    return axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(k)]), sizes[:k] / np.sqrt(len(x) - 1)


@pytest.mark.parametrize("width,k", [(5, 2), (40, 40), (150, 3)])
def test_axes_are_those_of_svd(spark, width, k):
    """Also where there are far fewer directions than dimensions, and where the mean is far from zero."""
    rng = np.random.default_rng(width)
    x = rng.normal(size=(400, width)) * np.linspace(3, 0.5, width) @ np.linalg.qr(rng.normal(size=(width, width)))[0] + 1000
    mean, axes, deviations = A.principal_axes(frame(spark, x), "v", k, width)
    want, sizes = svd(x, k)
    assert np.allclose(mean, x.mean(0))
    assert np.abs(axes - want).max() < 1e-6 and np.abs(deviations - sizes).max() < 1e-6


def test_scores(spark):
    x = np.random.default_rng(1).normal(size=(60, 7))
    rows = pca(frame(spark, x), "v", 2, "p").orderBy("id").collect()
    assert np.allclose(np.array([r["p"] for r in rows]), (x - x.mean(0)) @ svd(x, 2)[0])


def test_fewer_rows_than_axes(spark):
    x = np.random.default_rng(1).normal(size=(3, 6))
    _, axes, deviations = A.principal_axes(frame(spark, x), "v", 5, 6)
    assert axes.shape == (6, 5) and np.allclose(deviations[2:], 0)
