"""Best and mean scores of songs over all models, of which few are tried on each song."""

import math

import numpy as np
import pyarrow as pa
import pytest

from earshot.operators import scoring as S

MODEL = "user_id int, weights array<double>, intercept double"
SONG = "song_id int, a double, b double"


def a_case(n_models=150, n_songs=400, seed=1):
    numbers = np.random.default_rng(seed)
    models = [(u, numbers.normal(size=2).tolist(), float(numbers.normal())) for u in range(n_models)]
    songs = [(s, float(numbers.integers(0, 50)), float(numbers.random() * 100)) for s in range(n_songs)]
    return models, songs


@pytest.mark.parametrize("users_per_block, songs_per_block", [(32_768, 32_768), (7, 30)])
def test_scores_of_songs_equal_brute_force(spark, users_per_block, songs_per_block):
    models, songs = a_case()
    models += models[:20] + [(900, [0.0, 0.0], 1.0)] * 40 + [(901, [1.0, 1.0], None)]
    songs += songs[:10] + [(5, 60.0, 2.0), (None, 3.0, 4.0), (700, None, 1.0), (701, math.nan, 1.0)] + [(800 + i, 7.0, 7.0) for i in range(90)]
    out = S.song_scores(
        spark.createDataFrame(models, MODEL), spark.createDataFrame(songs, SONG), ["a", "b"], users_per_block, songs_per_block
    ).collect()
    want = {}
    for song, a, b in songs:
        if a is not None and not math.isnan(a):
            want.setdefault(song, []).extend(w[0] * a + w[1] * b + c for _, w, c in models if c is not None)
    assert len(out) == len(want) and {r.song_id for r in out} == set(want)
    for r in out:
        scores = want[r.song_id]
        assert r.users == len(scores) and r.mean_score == pytest.approx(np.mean(scores)) and r.best_score == pytest.approx(max(scores))


def test_a_model_that_is_no_number_is_the_best_of_all(spark):
    models, songs = a_case(20, 30)
    models.append((99, [math.nan, 0.0], 0.0))
    out = S.song_scores(spark.createDataFrame(models, MODEL), spark.createDataFrame(songs, SONG), ["a", "b"]).collect()
    assert len(out) == 30 and all(math.isnan(r.best_score) and math.isnan(r.mean_score) for r in out)


def test_no_models_or_no_songs(spark):
    models, songs = a_case(3, 3)
    m, s = spark.createDataFrame(models, MODEL), spark.createDataFrame(songs, SONG)
    assert S.song_scores(m.limit(0), s, ["a", "b"]).count() == 0 and S.song_scores(m, s.limit(0), ["a", "b"]).count() == 0


def test_few_models_are_sent_and_tried():
    """Not every model meets every song."""
    models, songs = a_case(20_000, 5_000)
    weights, intercepts = np.array([m[1] for m in models]), np.array([m[2] for m in models])
    values = np.array([x[1:] for x in songs])
    leaf = S._leaf_of(values, *S._tree(values, 6))
    low, high = (np.array([f(values[leaf == n], axis=0) for n in range(64)]) for f in (np.min, np.max))
    batch = pa.RecordBatch.from_arrays([pa.array(weights.tolist()), pa.array(intercepts)], names=["weights", "intercept"])
    floor = next(S._reached(low, high)(iter([batch]))).column("floor").to_numpy()
    best = (values @ weights.T + intercepts).max(axis=1)
    assert all(floor[n] <= best[leaf == n].min() for n in range(64))
    sent = list(S._contenders(low, high, floor, np.arange(64))(iter([batch])))
    assert sum(b.num_rows for b in sent) < 0.02 * 64 * len(models)
    found = S._greatest(
        pa.Table.from_batches([batch]),
        pa.table({"song_id": [x[0] for x in songs], "values": values.tolist(), "leaf": leaf, "part": pa.array([0] * len(songs), pa.int32())}),
    ).sort_by("song_id")
    assert np.allclose(found["best_score"].to_numpy(), best)
