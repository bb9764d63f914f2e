"""Scores of songs for listeners with linear models.

Scoring every song for every listener is a matrix product. It is computed by
blocks: models and songs are split by hash into blocks of bounded size, each
pair of blocks is one product worked off in chunks. For ranked lists songs are
laid out by their features in leaves of a tree instead. A listener's weights
bound the scores of a leaf from both sides, so only leaves that may hold one of
the best songs are scored, and only blocks that hold such a leaf are visited.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from earshot.session import ship_with_jobs, stage

ship_with_jobs(__name__)

SCORE_DIGITS = 9
CHUNK_SCORES = 1 << 20
# heard rows that one cell takes on average, at most
HEARD_ROWS = 1 << 21
# songs of a leaf, as long as there are no more leaves than LEAVES; songs the tree is fitted on
LEAF_SONGS = 128
LEAVES = 4096
TREE_SONGS = 1 << 16
# listeners whose leaves are worked off together
LISTENERS = 1024


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = pc.list_flatten(column.combine_chunks()).to_numpy(zero_copy_only=False)
    return flat.reshape(rows, -1) if rows else flat.reshape(0, 1)


def _cell(left: pa.Table, right: pa.Table):
    """Models, heard rows and songs in id order of one cell."""
    is_model = pc.is_valid(left["intercept"])
    return left.filter(is_model), left.filter(pc.invert(is_model)), right.sort_by("song_id")


def _score_chunks(models: pa.Table, songs: pa.Table):
    """Score matrices, listeners by songs, of as many listeners at a time as fit in memory."""
    weights = _matrix(models["weights"], models.num_rows)
    values = _matrix(songs["values"], songs.num_rows).T
    intercepts = models["intercept"].to_numpy()
    at_once = max(1, CHUNK_SCORES // max(1, songs.num_rows))
    for start in range(0, models.num_rows, at_once):
        chunk = slice(start, start + at_once)
        yield start, weights[chunk] @ values + intercepts[chunk, None]


def _result(models: pa.Table, songs: pa.Table, found: list[tuple[np.ndarray, ...]], *names: str) -> pa.Table:
    rows, columns, *scores = (np.concatenate(parts) for parts in zip(*found))
    return pa.table({
        "user_id": models["user_id"].combine_chunks().take(pa.array(rows)),
        "song_id": songs["song_id"].combine_chunks().take(pa.array(columns)),
        **{name: pa.array(values) for name, values in zip(names, scores)},
    })


def _empty(left: pa.Table, right: pa.Table, *names: str) -> pa.Table:
    return pa.table({
        "user_id": pa.array([], left.schema.field("user_id").type),
        "song_id": pa.array([], right.schema.field("song_id").type),
        **{name: pa.array([], pa.float64()) for name in names},
    })


def _all_scores(left: pa.Table, right: pa.Table) -> pa.Table:
    models, _, songs = _cell(left, right)
    if not models.num_rows or not songs.num_rows:
        return _empty(left, right, "score")
    found = []
    for start, scores in _score_chunks(models, songs):
        rows, columns = np.indices(scores.shape).reshape(2, -1)
        found.append((rows + start, columns, scores.ravel()))
    return _result(models, songs, found, "score")


def _best(ranked: np.ndarray, n: int) -> np.ndarray:
    """Mask of at least the ``n`` best finite entries of each row, with few more for ties."""
    mask = ranked > -np.inf
    if ranked.shape[1] <= n:
        return mask
    limit = -np.partition(-ranked, n - 1, axis=1)[:, n - 1]
    mask &= ranked >= limit[:, None]
    crowded = np.flatnonzero(mask.sum(axis=1) > 4 * n)
    if len(crowded):
        # songs are in id order, so a stable sort settles ties by song id
        order = np.argsort(-ranked[crowded], axis=1, kind="stable")[:, :n]
        exact = np.zeros((len(crowded), ranked.shape[1]), dtype=bool)
        np.put_along_axis(exact, order, True, axis=1)
        mask[crowded] &= exact
    return mask


def _tree(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Column and cut of the inner nodes of a complete tree, split at medians of the widest column."""
    columns, cuts = np.zeros(2**depth - 1, dtype=np.int64), np.zeros(2**depth - 1)
    points = points[np.isfinite(points).all(axis=1)]
    spread = np.ptp(points, axis=0) if len(points) else np.ones(points.shape[1])
    scaled = points / np.where(spread > 0, spread, 1.0)
    parts = [np.arange(len(points))]
    for node in range(len(cuts)):
        rows = parts[node]
        if len(rows):
            columns[node] = np.argmax(np.ptp(scaled[rows], axis=0))
            own = points[rows, columns[node]]
            # the greatest value stays above the cut, so that no side is empty if the values differ
            cuts[node] = min(np.median(own), np.max(own[own < own.max()], initial=own.min()))
        right = points[rows, columns[node]] > cuts[node]
        parts += [rows[~right], rows[right]]
    return columns, cuts


def _leaf_of(values: np.ndarray, columns: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    node = np.zeros(len(values), dtype=np.int64)
    rows = np.arange(len(values))
    for _ in range((len(cuts) + 1).bit_length() - 1):
        node = 2 * node + 1 + (values[rows, columns[node]] > cuts[node])
    return node - len(cuts)


def _bounds(weights: np.ndarray, intercepts: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Least and greatest scores [listeners, leaves], and what rounding may add to a score."""
    up, down = np.maximum(weights, 0.0), np.minimum(weights, 0.0)
    with np.errstate(invalid="ignore", over="ignore"):
        least = up @ low.T + down @ high.T + intercepts[:, None]
        greatest = up @ high.T + down @ low.T + intercepts[:, None]
        size = np.abs(weights) @ np.maximum(np.abs(low), np.abs(high)).max(axis=0) + np.abs(intercepts)
    # values that are not finite bound nothing
    least[np.isnan(least)], greatest[np.isnan(greatest)] = -np.inf, np.inf
    return least, greatest, 10.0 ** -SCORE_DIGITS + 1e-11 * np.nan_to_num(size, nan=0.0, posinf=0.0)


def _floor(least: np.ndarray, counts: np.ndarray, need: np.ndarray) -> np.ndarray:
    """A score that at least ``need`` songs of each listener reach; minus infinity if there are fewer songs."""
    floor = np.where(counts >= need[:, None], least, -np.inf).max(axis=1)
    rest = np.flatnonzero(floor == -np.inf)
    if len(rest):
        order = np.argsort(-least[rest], axis=1)
        enough = np.cumsum(counts[order], axis=1) >= need[rest, None]
        last = np.take_along_axis(order, enough.argmax(axis=1)[:, None], axis=1)[:, 0]
        floor[rest] = np.where(enough[:, -1], least[rest, last], -np.inf)
    return floor


def _visits(low: np.ndarray, high: np.ndarray, counts: np.ndarray, leaf_blocks: np.ndarray, n: int):
    """Task function that sends each model to the blocks whose songs may be among its ``n`` best unheard ones."""
    starts = np.flatnonzero(np.diff(leaf_blocks, prepend=-1))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, LISTENERS):
                models = batch.slice(start, LISTENERS)
                weights = _matrix(pa.chunked_array([models["weights"]]), models.num_rows)
                least, greatest, slack = _bounds(weights, models["intercept"].to_numpy(zero_copy_only=False), low, high)
                floor = _floor(least, counts, n + models["heard"].to_numpy()) - slack
                near = np.logical_or.reduceat(greatest + slack[:, None] >= floor[:, None], starts, axis=1)
                rows, blocks = np.nonzero(near)
                sent = models.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf_blocks[starts][blocks], pa.int32()), sent["user_id"], sent["weights"], sent["intercept"],
                     pa.array(floor[rows])], names=["block", "user_id", "weights", "intercept", "floor"],
                )

    return visits


def _best_scores(n: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The ``n`` best unheard songs of a cell for each listener, leaf by leaf."""

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        models, heard, songs = _cell(left, right)
        if not models.num_rows or not songs.num_rows:
            return _empty(left, right, "score", "ranked")
        # songs keep their id order inside a leaf; ids settle ties
        songs = songs.append_column("at", pa.array(np.arange(songs.num_rows)))
        songs = songs.sort_by([("leaf", "ascending"), ("at", "ascending")])
        at = songs["at"].to_numpy()
        values = _matrix(songs["values"], songs.num_rows)
        starts = np.flatnonzero(np.diff(songs["leaf"].to_numpy(), prepend=-1))
        ends = np.append(starts[1:], songs.num_rows)
        low, high = np.minimum.reduceat(values, starts), np.maximum.reduceat(values, starts)
        user = pc.index_in(heard["user_id"], models["user_id"].combine_chunks())
        song = pc.index_in(heard["song_id"], songs["song_id"].combine_chunks())
        known = pc.and_(pc.is_valid(user), pc.is_valid(song))
        user, song = user.filter(known).to_numpy(), song.filter(known).to_numpy()
        order = np.lexsort((song, user // LISTENERS))
        user, song = user[order], song[order]
        weights, intercepts = _matrix(models["weights"], models.num_rows), models["intercept"].to_numpy()
        floors = models["floor"].to_numpy()
        found = []
        for start in range(0, models.num_rows, LISTENERS):
            chunk = slice(start, start + LISTENERS)
            own, constant, floor = weights[chunk], intercepts[chunk], floors[chunk].copy()
            _, greatest, slack = _bounds(own, constant, low, high)
            greatest += slack[:, None]
            here = slice(*np.searchsorted(user // LISTENERS, [start // LISTENERS, start // LISTENERS + 1]))
            heard_user, heard_song = user[here] - start, song[here]
            kept = []
            for leaf in np.argsort(-np.nan_to_num(greatest).mean(axis=0), kind="stable"):
                rows = np.flatnonzero(greatest[:, leaf] >= floor)
                if not len(rows):
                    continue
                first, end = starts[leaf], ends[leaf]
                scores = own[rows] @ values[first:end].T + constant[rows, None]
                ranked = np.round(scores, SCORE_DIGITS)
                place = np.full(len(own), -1)
                place[rows] = np.arange(len(rows))
                gone = slice(*np.searchsorted(heard_song, [first, end]))
                asked = place[heard_user[gone]] >= 0
                ranked[place[heard_user[gone][asked]], heard_song[gone][asked] - first] = -np.inf
                r, c = np.nonzero(_best(ranked, n) & (ranked >= floor[rows, None]))
                kept.append((rows[r], first + c, scores[r, c], ranked[r, c]))
                if end - first >= n:
                    # a later song must reach the n-th best so far
                    floor[rows] = np.fmax(floor[rows], -np.partition(-ranked, n - 1, axis=1)[:, n - 1])
            if kept:
                rows, columns, scores, ranked = (np.concatenate(parts) for parts in zip(*kept))
                order = np.lexsort((at[columns], -ranked, rows))
                sizes = np.bincount(rows, minlength=1)
                order = order[np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes) < n]
                found.append((rows[order] + start, columns[order], scores[order], ranked[order]))
        return _result(models, songs, found, "score", "ranked") if found else _empty(left, right, "score", "ranked")

    return best


def _score_cells(
    models: DataFrame, songs: DataFrame, features: Sequence[str],
    function: Callable[[pa.Table, pa.Table], pa.Table], users_per_block: int, songs_per_block: int,
    schema: T.StructType | None = None,
) -> DataFrame:
    models = stage(models.select("user_id", "weights", "intercept"), "models")
    n_users = models.count()
    # large blocks are copied least; small data still gets a cell for every core
    spread = 2 * models.sparkSession.sparkContext.defaultParallelism
    user_blocks = max(n_users // users_per_block + 1, min(spread, n_users // 256 + 1))
    song_blocks = songs.count() // songs_per_block + 1

    def block(column: str, count: int):
        return F.pmod(F.xxhash64(column), F.lit(count)).cast("int")

    def every(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    user_type, song_type = models.schema["user_id"].dataType, songs.schema["song_id"].dataType
    user_block = block("user_id", user_blocks).alias("user_block")
    left = models.select(
        user_block, every(song_blocks).alias("song_block"), "user_id",
        F.lit(None).cast(song_type).alias("song_id"), "weights", "intercept",
    )
    right = songs.dropna(subset=list(features)).select(
        every(user_blocks).alias("user_block"), block("song_id", song_blocks).alias("song_block"), "song_id",
        F.array(*[F.col(c).cast("double") for c in features]).alias("values"),
    )
    schema = schema or T.StructType([
        T.StructField("user_id", user_type), T.StructField("song_id", song_type),
        T.StructField("score", T.DoubleType()),
    ])
    cell = ["user_block", "song_block"]
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(function, schema)


def score_all(
    models: DataFrame, songs: DataFrame, features: Sequence[str],
    users_per_block: int = 512, songs_per_block: int = 1024,
) -> DataFrame:
    """``(user_id, song_id, score)`` of every song with complete features for every model."""
    return _score_cells(models, songs, features, _all_scores, users_per_block, songs_per_block)


def _laid_out(songs: DataFrame, features: Sequence[str], songs_per_block: int):
    """Songs in blocks and leaves of a tree over their features, and what is known of the leaves.

    Returns ``(song_id, values, leaf, block)``, stored, the number of blocks, and of each
    leaf its songs, its block, and the least and greatest values.
    """
    values = F.array(*[F.col(c).cast("double") for c in features]).alias("values")
    songs = stage(songs.dropna(subset=list(features)).select("song_id", values), "scored-songs")
    n_songs = songs.count()
    block_depth = max(0, (n_songs - 1) // songs_per_block).bit_length()
    depth = max(block_depth, min(LEAVES.bit_length() - 1, (n_songs // LEAF_SONGS).bit_length()))
    sample = songs.orderBy(F.xxhash64("song_id", "values")).limit(TREE_SONGS).select("values").collect()
    columns, cuts = _tree(np.array([r.values for r in sample], dtype=float).reshape(len(sample), len(features)), depth)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = _leaf_of(_matrix(pa.chunked_array([batch["values"]]), batch.num_rows), columns, cuts)
            yield batch.append_column("leaf", pa.array(leaf, pa.int32()))

    laid = songs.mapInArrow(placed, T.StructType([*songs.schema, T.StructField("leaf", T.IntegerType())]))
    laid = stage(laid.withColumn("block", F.shiftright("leaf", depth - block_depth)), "song-leaves")
    ends = [f(F.col("values")[i]) for f in (F.min, F.max) for i in range(len(features))]
    leaves = sorted(map(tuple, laid.groupBy("leaf", "block").agg(F.count("*"), *ends).collect()))
    if not leaves:
        leaves = [(0, 0, 0, *[0.0] * (2 * len(features)))]
    numbers = np.array(leaves, dtype=float)
    counts, leaf_blocks = numbers[:, 2].astype(np.int64), numbers[:, 1].astype(np.int64)
    return laid, 2**block_depth, counts, leaf_blocks, numbers[:, 3:3 + len(features)], numbers[:, 3 + len(features):]


def _slots(counts: np.ndarray, leaf_blocks: np.ndarray, blocks: int, songs_per_block: int):
    """In how many parts each block's songs go: those too alike to be told apart by the tree are cut by hash."""
    in_block = np.bincount(leaf_blocks, counts, minlength=blocks).astype(int)
    return F.get(F.lit([int(c) // songs_per_block // 2 + 1 for c in in_block]), F.col("block"))


def _reached(low: np.ndarray, high: np.ndarray):
    """Task function that gives a score of each leaf that some model reaches on all of its songs."""

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = np.full(len(low), -np.inf)
        for batch in batches:
            for start in range(0, batch.num_rows, LISTENERS):
                models = batch.slice(start, LISTENERS)
                weights = _matrix(pa.chunked_array([models["weights"]]), models.num_rows)
                least, _, slack = _bounds(weights, models["intercept"].to_numpy(zero_copy_only=False), low, high)
                floor = np.maximum(floor, (least - slack[:, None]).max(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(low)), pa.int32()), pa.array(floor)], names=["place", "floor"])

    return reached


def _contenders(low: np.ndarray, high: np.ndarray, floor: np.ndarray, leaf_blocks: np.ndarray):
    """Task function that sends each model to the blocks where it may give a song its best score."""
    starts = np.flatnonzero(np.diff(leaf_blocks, prepend=-1))

    def contenders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, LISTENERS):
                models = batch.slice(start, LISTENERS)
                weights = _matrix(pa.chunked_array([models["weights"]]), models.num_rows)
                _, greatest, slack = _bounds(weights, models["intercept"].to_numpy(zero_copy_only=False), low, high)
                rows, blocks = np.nonzero(np.logical_or.reduceat(greatest + slack[:, None] >= floor, starts, axis=1))
                sent = models.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf_blocks[starts][blocks], pa.int32()), sent["weights"], sent["intercept"]],
                    names=["block", "weights", "intercept"],
                )

    return contenders


def _greatest(left: pa.Table, right: pa.Table) -> pa.Table:
    """The best score of each song of a cell, leaf by leaf; a model is tried where its bound beats what is found."""
    songs = right.sort_by([("leaf", "ascending")])
    best = np.full(songs.num_rows, -np.inf)
    if left.num_rows and songs.num_rows:
        values = _matrix(songs["values"], songs.num_rows)
        starts = np.flatnonzero(np.diff(songs["leaf"].to_numpy(), prepend=-1))
        ends = np.append(starts[1:], songs.num_rows)
        low, high = np.minimum.reduceat(values, starts), np.maximum.reduceat(values, starts)
        all_weights, all_intercepts = _matrix(left["weights"], left.num_rows), left["intercept"].to_numpy()
        for start in range(0, left.num_rows, LISTENERS):
            weights, intercepts = all_weights[start:start + LISTENERS], all_intercepts[start:start + LISTENERS]
            _, greatest, slack = _bounds(weights, intercepts, low, high)
            greatest += slack[:, None]
            for leaf, (first, end) in enumerate(zip(starts, ends)):
                # a song without a number as its best score keeps it
                worst = np.fmin.reduce(best[first:end])
                rows = np.flatnonzero(greatest[:, leaf] >= worst)
                at_once = max(1, CHUNK_SCORES // (end - first))
                for at in range(0, len(rows), at_once):
                    tried = rows[at:at + at_once]
                    scores = weights[tried] @ values[first:end].T + intercepts[tried, None]
                    best[first:end] = np.maximum(best[first:end], scores.max(axis=0))
    return pa.table({
        "song_id": songs["song_id"].combine_chunks(), "values": songs["values"].combine_chunks(),
        "part": songs["part"].combine_chunks(), "best_score": pa.array(best),
    })


def song_scores(
    models: DataFrame, songs: DataFrame, features: Sequence[str],
    users_per_block: int = 32_768, songs_per_block: int = 32_768,
) -> DataFrame:
    """``(song_id, users, mean_score, best_score)`` over every model.

    A sum of linear scores is the score by summed weights, so the mean takes one
    pass over the models. For the best score songs lie in leaves of a tree over
    their features: exact bounds over a leaf leave few models that may be the
    best of one of its songs, and only those are scored there. The tree decides
    the time but not the result.
    """
    own = models.where("intercept IS NOT NULL").select("weights", "intercept")
    models = stage(own, "models")
    laid, blocks, counts, leaf_blocks, low, high = _laid_out(songs, features, songs_per_block)
    n, intercept, *weights = models.agg(
        F.count("*"), F.sum("intercept"), *[F.sum(F.col("weights")[i]) for i in range(len(features))]
    ).first()
    floors = models.mapInArrow(_reached(low, high), "place int, floor double").groupBy("place").agg(F.max("floor").alias("floor"))
    floor = np.full(len(low), -np.inf)
    for row in floors.collect():
        floor[row.place] = row.floor
    sent = stage(models.mapInArrow(
        _contenders(low, high, floor, leaf_blocks), "block int, weights array<double>, intercept double"
    ), "sent-models")
    slots = _slots(counts, leaf_blocks, blocks, songs_per_block)
    spread = 2 * models.sparkSession.sparkContext.defaultParallelism // blocks + 1
    parts = [1] * blocks
    for r in sent.groupBy("block").count().collect():
        parts[r["block"]] = max(r["count"] // users_per_block + 1, min(spread, r["count"] // 256 + 1))
    split = F.get(F.lit(parts), F.col("block"))
    left = sent.select(
        "block", F.explode(F.sequence(F.lit(0), slots - 1)).alias("slot"),
        F.pmod(F.xxhash64("weights", "intercept"), split).cast("int").alias("part"), "weights", "intercept",
    )
    right = laid.select(
        "block", F.pmod(F.xxhash64("song_id"), slots).cast("int").alias("slot"),
        F.explode(F.sequence(F.lit(0), split - 1)).alias("part"), "song_id", "leaf", "values",
    )
    cell = ["block", "slot", "part"]
    best = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_greatest, T.StructType([
        songs.schema["song_id"], T.StructField("values", T.ArrayType(T.DoubleType())),
        T.StructField("part", T.IntegerType()), T.StructField("best_score", T.DoubleType()),
    ]))
    total = sum((F.col("values")[i] * F.lit(w) for i, w in enumerate(weights)), F.lit(intercept))
    # a song's row comes once for each part of the models and counts in one of them
    once = F.col("part") == 0
    return best.groupBy("song_id").agg(
        F.sum(F.when(once, F.lit(n).cast("bigint")).otherwise(0)).alias("users"),
        (F.sum(F.when(once, total)) / F.sum(F.when(once, F.lit(n).cast("bigint")).otherwise(0))).alias("mean_score"),
        F.max("best_score").alias("best_score"),
    ).where("users > 0")


def recommend_top_n(
    models: DataFrame, songs: DataFrame, features: Sequence[str], plays: DataFrame, n: int = 10,
    users_per_block: int = 32_768, songs_per_block: int = 32_768,
) -> DataFrame:
    """The ``n`` best unheard songs of each listener as ``place`` 1…n, ties by song id.

    Scores are rounded for ranking once, where they are computed: cells and the
    last ranking compare the same values. A tree fitted on a bounded sample of
    the songs lays them out; which leaves a listener needs follows from exact
    bounds over all songs of each leaf, so the tree decides the time but not
    the result. Listeners whose weights are all zero tie on every song and
    still visit all leaves.
    """
    heard = stage(plays.select("user_id", "song_id").distinct(), "heard-songs")
    user_type, song_type = models.schema["user_id"], songs.schema["song_id"]
    schema = T.StructType([
        user_type, song_type, T.StructField("score", T.DoubleType()), T.StructField("ranked", T.DoubleType()),
    ])
    laid, blocks, counts, leaf_blocks, low, high = _laid_out(songs, features, songs_per_block)

    listeners = heard.groupBy(F.col("user_id").alias("heard_by")).agg(F.count("*").alias("heard"))
    known = models.select("user_id", "weights", "intercept").join(
        listeners, F.col("user_id").eqNullSafe(F.col("heard_by")), "left"
    ).select("user_id", "weights", "intercept", F.coalesce("heard", F.lit(0).cast("bigint")).alias("heard"))
    sent = stage(known.mapInArrow(_visits(low, high, counts, leaf_blocks, n), T.StructType([
        T.StructField("block", T.IntegerType()), user_type, T.StructField("weights", T.ArrayType(T.DoubleType())),
        T.StructField("intercept", T.DoubleType()), T.StructField("floor", T.DoubleType()),
    ])), "sent-models")
    slots = _slots(counts, leaf_blocks, blocks, songs_per_block)
    slot = F.pmod(F.xxhash64("song_id"), slots).cast("int").alias("slot")
    laid = laid.select("*", slot)
    homes = laid.select(F.col("song_id").alias("home_of"), "block", "slot").distinct()
    met = stage(heard.join(homes, F.col("song_id").eqNullSafe(F.col("home_of"))).select(
        "block", "slot", "user_id", F.col("song_id").cast(song_type.dataType).alias("song_id")
    ), "heard-cells")
    spread = 2 * models.sparkSession.sparkContext.defaultParallelism // blocks + 1
    parts = [1] * blocks
    for r in sent.groupBy("block").count().collect():
        parts[r["block"]] = max(r["count"] // users_per_block + 1, min(spread, r["count"] // 256 + 1))
    for r in met.groupBy("block").count().collect():
        parts[r["block"]] = max(parts[r["block"]], r["count"] // HEARD_ROWS + 1)
    split = F.get(F.lit(parts), F.col("block"))
    part = F.pmod(F.xxhash64("user_id"), split).cast("int").alias("part")
    left = sent.select(
        "block", F.explode(F.sequence(F.lit(0), slots - 1)).alias("slot"), part, "user_id",
        F.lit(None).cast(song_type.dataType).alias("song_id"), "weights", "intercept", "floor",
    ).unionByName(met.select("block", "slot", part, "user_id", "song_id"), allowMissingColumns=True)
    right = laid.select("block", "slot", F.explode(F.sequence(F.lit(0), split - 1)).alias("part"), "song_id", "leaf", "values")
    cell = ["block", "slot", "part"]
    scores = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_best_scores(n), schema)
    by_score = W.partitionBy("user_id").orderBy(F.desc("ranked"), "song_id")
    return scores.select("user_id", "song_id", "score", F.row_number().over(by_score).alias("place")).where(F.col("place") <= n)
