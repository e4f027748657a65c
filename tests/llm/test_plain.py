"""Parts of the operators against the plainest form of what they compute."""

import random

import numpy as np

from dripline.llm import decontamination, mixing, quality


def plain_alignment(item, doc):
    """Smith-Waterman cell by cell."""
    table = [[0] * (len(doc) + 1) for _ in range(len(item) + 1)]
    for i, w in enumerate(item, 1):
        for j, v in enumerate(doc, 1):
            meet = table[i - 1][j - 1] + (decontamination.MATCH if w == v else decontamination.MISMATCH)
            table[i][j] = max(0, meet, table[i - 1][j] + decontamination.GAP, table[i][j - 1] + decontamination.GAP)
    return table


def test_alignment():
    draw = random.Random(1)
    for _ in range(400):
        item = [draw.randrange(6) for _ in range(draw.randrange(1, 14))]
        doc = [draw.randrange(6) for _ in range(draw.randrange(0, 30))]
        if draw.random() < 0.5:
            at = draw.randrange(len(doc) + 1)
            doc[at:at] = [w for w in item if draw.random() < 0.8]
        score, end = decontamination.align(np.array(item, np.uint64), np.array(doc, np.uint64))
        table = plain_alignment(item, doc)
        assert score == max(map(max, table))
        assert score == 0 or score == max(row[end] for row in table)


def plain_seats(votes, seats, most):
    held = [0] * len(votes)
    for _ in range(seats):
        able = [k for k in range(len(votes)) if held[k] < most[k] and votes[k] > 0]
        if not able:
            break
        k = max(able, key=lambda k: (votes[k] / (2 * held[k] + 1), -k))
        held[k] += 1
    return held


def test_apportionment():
    draw = random.Random(2)
    for _ in range(500):
        n = draw.randrange(1, 8)
        votes = [draw.random() * draw.choice([0, 1, 20]) for _ in range(n)]
        seats = round(sum(votes))
        most = [max(draw.randrange(1, 60), int(v + 0.5)) for v in votes]
        assert mixing.apportion(votes, seats, most) == plain_seats(votes, seats, most), (votes, seats, most)
    assert mixing.apportion([10.0, 1.0, 1.0], 4, [9, 9, 9]) == plain_seats([10.0, 1.0, 1.0], 4, [9, 9, 9]) == [4, 0, 0]


def test_quotas_have_the_house_quota_in_sum():
    for votes in ([3.3, 3.3, 3.4], [0.5, 0.5, 9.0], [2.5, 2.5, 5.0]):
        assert sum(mixing.apportion(votes, 10, [99] * 3)) == 10


def made_rows(spark, n=700):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(n, quality.WIDTH)) * draw.uniform(0.1, 9, quality.WIDTH)
    x[:, 3] = 1.0  # a statistic without any spread
    y = (x[:, 0] + draw.normal(size=n) > 0).astype(float)
    rows = [(v.tolist(), float(t)) for v, t in zip(x, y)]
    return x, y, spark.createDataFrame(rows, "x array<double>, y double").repartition(5)


def test_normal_equations_and_standardisation(spark):
    x, y, train = made_rows(spark)
    mean, spread = quality._moments(train)
    assert np.allclose(mean, x.mean(0)) and np.allclose(spread, np.where(x.std(0) > 1e-9, x.std(0), 1))
    model = quality.Model(mean, spread, None, np.zeros(1), np.zeros(1))
    z = model.features(x)
    total = quality._normal_equations(train, model)
    assert np.allclose(total[:, :-1], z.T @ z) and np.allclose(total[:, -1], z.T @ y)
    fitted = quality.fit(train)
    gap = z.T @ (y - z @ fitted.weights)
    ridge = gap / np.where(np.abs(fitted.weights) > 1e-9, fitted.weights, np.nan)
    assert np.nanmedian(np.abs(ridge - quality.RIDGE)) < 1e-4


def test_kernel_is_nearly_gaussian():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(60, quality.WIDTH))
    model = quality.Model(np.zeros(quality.WIDTH), np.ones(quality.WIDTH), None, np.zeros(1), np.zeros(1))
    cosines = model.features(x)[:, : quality.COSINES]
    near = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * quality.KERNEL**2))
    assert np.abs(cosines @ cosines.T - near).mean() < 0.05


def test_calibration_is_the_isotonic_fit(spark):
    x, y, train = made_rows(spark)
    model = quality.fit(train)
    raw = model.raw(x)
    at = np.clip((raw - quality.LOW) / (quality.HIGH - quality.LOW) * quality.BINS, 0, quality.BINS - 1).astype(int)
    bins = np.unique(at)
    n, good = (np.array([w[at == b].sum() for b in bins]) for w in (np.ones(len(y)), y))
    mean = lambda a, b: good[a : b + 1].sum() / n[a : b + 1].sum()
    want = [max(min(mean(a, b) for b in range(i, len(bins))) for a in range(i + 1)) for i in range(0, len(bins), 9)]
    centres = (bins[::9] + 0.5) / quality.BINS * (quality.HIGH - quality.LOW) + quality.LOW
    # A pool is one level at its centre: the fit's levels in order are those of the plain form.
    assert (np.diff(model.levels) > 0).all() and set(np.round(want, 9)) <= set(np.round(model.levels, 9))
    assert np.corrcoef(np.interp(centres, model.knots, model.levels), want)[0, 1] > 0.98
