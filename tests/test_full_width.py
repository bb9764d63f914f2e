"""Models and profiles on all default columns, against NumPy."""

import numpy as np
import pytest

from earshot.operators import features as X
from earshot.operators import regression as G
from earshot.operators.catalog import profile_features
from earshot.plans.profiles import user_profile
from earshot.suite import content
from earshot.suite import tables as T
from earshot.suite.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
NAMES = X.NUMERIC_FEATURES


@pytest.fixture(scope="module")
def users(spark):
    rows = content._full_rows(spark, FOLDER).select("user_id", "song_id", "label", *NAMES).collect()
    out = {}
    for r in sorted(rows):
        out.setdefault(r.user_id, []).append(r)
    return {u: (np.array([r[3:] for r in own]), np.array([r.label for r in own])) for u, own in out.items()}


def weights(row):
    return np.array([row[f"w_{n}"] for n in NAMES])


def test_least_squares_on_fourteen_features(spark, users):
    models = {r.user_id: r for r in QUERIES["full_width_least_squares_models"](spark, FOLDER).collect()}
    assert models.keys() == users.keys() and len(models) > 50
    several = 0
    for user, (x, y) in users.items():
        fit, *_ = np.linalg.lstsq((x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1), y - y.mean(), rcond=1e-7)
        wanted = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1) @ fit + y.mean()
        assert x @ weights(models[user]) + models[user].intercept == pytest.approx(wanted, abs=5e-3)
        several += len(y) > 15
    assert several > 10


def test_descent_on_fourteen_features(spark, users):
    models = {r.user_id: r for r in QUERIES["full_width_descent_models"](spark, FOLDER).collect()}
    for user, (x, y) in users.items():
        std = x.std(0)
        scale = np.where(std > 1e-9, 1 / np.where(std > 1e-9, std, 1), 0)
        z, w = (x - x.mean(0)) * scale, np.zeros(len(NAMES))
        for t in range(1, 11):
            new = w - 1 / np.sqrt(t) * ((z @ w - y)[:, None] * z).mean(0)
            change, w = np.linalg.norm(new - w), new
            if t > 1 and change < 0.001 * max(np.linalg.norm(w), 1.0):
                break
        assert weights(models[user]) == pytest.approx(w * scale, rel=1e-4, abs=2e-6)


def test_elastic_net_on_fourteen_features(spark, users):
    models = {r.user_id: r for r in QUERIES["full_width_elastic_net_models"](spark, FOLDER).collect()}
    checked = 0
    for user, (x, y) in users.items():
        if y.std() == 0:
            assert not weights(models[user]).any()
            continue
        w, s = weights(models[user]), x.std(0)
        moves = s > 0
        z = (x[:, moves] - x[:, moves].mean(0)) / s[moves]
        slope = (z * (y - y.mean() - z @ (w * s)[moves])[:, None]).mean(0) - 0.02 * 0.2 / y.std() * (w * s)[moves]
        free = w[moves] == 0
        assert np.abs(slope[free]).max(initial=0) <= 0.02 * 0.8 + 1e-3
        assert slope[~free] == pytest.approx(np.sign(w[moves][~free]) * 0.02 * 0.8, abs=1e-3)
        checked += (~free).any()
    assert checked > 50


def test_profiles_on_nine_features(spark):
    songs = profile_features(T.songs(spark, FOLDER, full=True)).withColumnRenamed("trackID", "track_id")
    rows = user_profile(T.lines(spark, FOLDER), T.song_tracks(spark, FOLDER), T.track_paths(spark, FOLDER), songs).collect()
    by_user = {}
    for r in rows:
        by_user.setdefault(r.user_id, []).append(r)
    errors = {r.user_id: r for r in QUERIES["full_width_profile_errors"](spark, FOLDER).collect()}
    wanted = {u: sorted(own, key=lambda r: r.song_id) for u, own in by_user.items() if len(own) > 21}
    assert errors.keys() == wanted.keys() and errors
    for user, own in wanted.items():
        x = np.array([[r[c] for c in X.PROFILE_FEATURES] for r in own])
        y = np.array([r.label for r in own])
        if np.linalg.matrix_rank(x[:21] - x[:21].mean(0)) < x.shape[1]:
            continue
        fit, *_ = np.linalg.lstsq(np.c_[x[:21], np.ones(21)], y[:21], rcond=None)
        error = ((np.c_[x[21:], np.ones(len(own) - 21)] @ fit - y[21:]) ** 2).mean()
        assert errors[user].mse == pytest.approx(error, rel=1e-4, abs=1e-5) and errors[user].n == len(own) - 21
