"""Near-duplicate vectors by a forest of random-projection trees with spill.

Each tree cuts the vectors again and again at the median of a random
projection; a vector close to a cut goes to both sides. Vectors are compared
only within leaves, exactly and in double precision. Cuts are fitted on a
bounded sample of vectors, the index holds all of them. Equal vectors are one
entry with a count, and a leaf hands on counts and a spanning set of links,
never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import TAG, numbered, restored
from earshot.llm.components import connected_components, over_groups, split_hot
from earshot.session import ship_with_jobs, stage

THRESHOLD = 0.98
TREES = 6
LEAF = 128
# spill on either side of a cut, in standard deviations of the projected difference of a pair at the threshold
SPILL = 0.8
# vectors the cuts are fitted on, and the fewest a node of its own needs
SAMPLE = 20_000
NODE = 16
CAP = 4096


class Forest:
    """Cuts of all trees: for each level a direction, and a threshold per node.

    Levels below the last with enough sample vectors use thresholds of the
    node's ancestor there, so the size is bounded by the sample and the depth.
    """

    def __init__(self, sample: np.ndarray, count: int, trees: int, leaf: int, width: float, seed: int = 7):
        self.depth = max(0, ceil(log2(max(count, 1) / leaf)))
        self.full = min(self.depth, max(0, int(log2(max(len(sample), 1) / NODE))))
        self.width = width
        random = np.random.default_rng(seed)
        directions = random.standard_normal((trees, self.depth, sample.shape[1]))
        self.directions = directions / np.maximum(np.linalg.norm(directions, axis=2, keepdims=True), 1e-12)
        self.cuts = []
        for tree in range(trees):
            shadow = sample @ self.directions[tree].T
            node = np.zeros(len(sample), dtype=np.int64)
            levels = []
            for level in range(self.depth):
                known = 1 << min(level, self.full)
                cut = np.full(known, np.median(shadow[:, level]) if len(sample) else 0.0)
                order = np.argsort(node, kind="stable")
                edges = np.searchsorted(node[order], np.arange(known + 1))
                for i in range(known):
                    if edges[i + 1] > edges[i]:
                        cut[i] = np.median(shadow[order[edges[i]:edges[i + 1]], level])
                levels.append(cut)
                if level < self.full:
                    node = node * 2 + (shadow[:, level] > cut[node])
            self.cuts.append(levels)

    def leaves(self, vectors: np.ndarray, tree: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and leaf numbers, a row once for each leaf it falls in."""
        shadow = vectors @ self.directions[tree].T
        row = np.arange(len(vectors))
        node = np.zeros(len(vectors), dtype=np.int64)
        for level, cut in enumerate(self.cuts[tree]):
            known = node >> max(0, level - self.full)
            offset = shadow[row, level] - cut[known]
            left, right = offset <= self.width, offset > -self.width
            row = np.concatenate([row[left], row[right]])
            node = np.concatenate([node[left] * 2, node[right] * 2 + 1])
        return row, node


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scale = np.abs(vectors).max(axis=1, keepdims=True)
    scaled = vectors / scale
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _in_leaves(entries: DataFrame, forests: dict[int, Forest]) -> DataFrame:
    """A row per vector, tree and leaf, with the leaves the vector met before."""
    shared = entries.sparkSession.sparkContext.broadcast({dim: vars(f) for dim, f in forests.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                forest = restored(Forest, shared.value[int(dim)])
                unit = _unit(_matrix(part.column("vector"), int(dim)))
                label = part.column("label_key").to_numpy()
                rows, leaves = [], []
                for tree in range(len(forest.cuts)):
                    row, leaf = forest.leaves(unit, tree)
                    # one number for dim, label, tree and leaf; leaves that clash only hold more to compare
                    mixed = np.array([dim, tree], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    key = (leaf.astype(np.uint64) + mixed[0]) * np.uint64(0xC2B2AE3D27D4EB4F)
                    key ^= (mixed[1] + label[row].view(np.uint64)) * np.uint64(0x165667B19E3779F9)
                    rows.append(row)
                    leaves.append(key.view(np.int64))
                row, leaf = np.concatenate(rows), np.concatenate(leaves)
                order = np.argsort(row, kind="stable")
                row, leaf = row[order], leaf[order]
                first = np.searchsorted(row, row)
                place = np.arange(len(row))
                spans = place - first
                offsets = np.concatenate([[0], np.cumsum(spans)])
                inside = np.arange(offsets[-1]) - np.repeat(offsets[:-1], spans) + np.repeat(first, spans)
                earlier = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(leaf[inside]))
                taken = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf), taken.column("node"), taken.column("label_key"), taken.column("dim"),
                     taken.column("copies"), taken.column("vector"), earlier],
                    names=["leaf", "node", "label_key", "dim", "copies", "vector", "earlier"],
                )

    return entries.mapInArrow(
        run, "leaf bigint, node bigint, label_key bigint, dim int, copies bigint, vector array<double>, "
             "earlier array<bigint>",
    )


def _compare(threshold: float):
    def one(node, unit, label, copies, own, crossing, earlier):
        """New partners of each row, and the smallest row it is connected to."""
        m = len(node)
        flat = earlier.flatten().to_numpy()
        names, code = np.unique(flat, return_inverse=True)
        met = np.zeros((m, max(len(names), 1)), dtype=np.float32)
        met[np.repeat(np.arange(m), np.diff(earlier.offsets.to_numpy())), code] = 1
        partners, roots = np.zeros(m, dtype=np.int64), np.arange(m)
        step = max(1, (1 << 21) // m)
        again = True
        first = True
        while again:
            new = roots.copy()
            found = False
            for start in range(0, m, step):
                part = slice(start, start + step)
                linked = unit[part] @ unit.T >= threshold
                linked &= (label[part, None] == label[None, :]) & (node[part, None] != node[None, :])
                if crossing:
                    linked &= own[part, None] != own[None, :]
                if not linked.any():
                    continue
                found = True
                if first:
                    partners[part] = (linked & (met[part] @ met.T == 0)) @ copies
                new[part] = np.minimum(new[part], np.where(linked, roots[None, :], m).min(axis=1))
            first = False
            np.minimum.at(new, roots, new.copy())
            new = new[new]
            again = found and not (new == roots).all()
            roots = new
        return partners, roots

    def compare(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch | None:
        nodes, label, dims, copies, own = (
            table.column(c).to_numpy() for c in ("node", "label_key", "dim", "copies", "own")
        )
        crossing = table.column("lo").to_numpy() != table.column("hi").to_numpy()
        vector, earlier = table.column("vector").combine_chunks(), table.column("earlier").combine_chunks()
        out: list[list[np.ndarray]] = [[], [], []]
        for start, end in zip(starts[:-1], starts[1:]):
            for dim in np.unique(dims[start:end]) if end - start > 1 else ():
                rows = start + np.flatnonzero(dims[start:end] == dim)
                unit = _unit(_matrix(vector.take(pa.array(rows)), int(dim)))
                partners, roots = one(nodes[rows], unit, label[rows], copies[rows], own[rows], crossing[start],
                                      earlier.take(pa.array(rows)))
                keep = (partners > 0) | (roots != np.arange(len(rows)))
                out[0].append(nodes[rows][keep])
                out[1].append(nodes[rows][roots][keep])
                out[2].append(partners[keep])
        if not out[0]:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["a", "b", "partners"])

    return compare


def near_vectors(
    table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    threshold: float = THRESHOLD, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, sample: int = SAMPLE,
    cap: int = CAP,
) -> DataFrame:
    """``row_tag``, ``vec_id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``table``.

    Two vectors of equal label and length link if their cosine is at least
    ``threshold``. Null, empty and zero vectors, vectors with null or
    non-finite components, and rows without label or id link with nothing:
    they are a component of their own (``kept`` is false for a null id).
    Rows with a repeated id are vectors of their own. An empty table gives no
    rows.
    """
    source = numbered(table.select(id_column, vector_column, label_column))
    vector = F.col(vector_column).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)
    rows = stage(
        source.select(
            TAG, F.col(id_column).alias("vec_id"), F.xxhash64(label_column).alias("label_key"),
            F.col(label_column).alias("label"), vector.alias("vector"), F.size(vector).alias("dim"),
            F.coalesce(usable & F.col(label_column).isNotNull() & F.col(id_column).isNotNull(), F.lit(False)).alias("ok"),
        ),
        "vector-rows",
    )
    first = F.min(F.struct("vec_id", TAG))
    entries = stage(
        rows.where("ok").groupBy("label", "label_key", "dim", "vector")
        .agg(first.alias("first"), F.count("*").alias("copies"))
        .withColumn("node", F.col(f"first.{TAG}")),
        "vector-entries",
    )
    width = spill * np.sqrt(2 - 2 * threshold)
    forests = {}
    for dim, count in entries.groupBy("dim").count().collect():
        chance = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) / float(1 << 30)
        drawn = entries.where((F.col("dim") == dim) & (chance < sample / count)).select("vector").toArrow()
        fitted = _unit(_matrix(drawn.column("vector").combine_chunks(), dim)) if drawn.num_rows else np.zeros((0, dim))
        forests[dim] = Forest(fitted, count, trees, leaf, width / np.sqrt(dim))
    met = split_hot(_in_leaves(entries, forests), "leaf", "node", cap)
    found = stage(
        over_groups(met, ["leaf", "lo", "hi"], _compare(threshold), "a bigint, b bigint, partners bigint"), "vector-links"
    )
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("partners").alias("partners"))
    groups = connected_components(found.where("a <> b").select("a", "b").distinct())
    answer = stage(
        entries.select("label_key", "dim", "vector", "node", "first", "copies")
        .join(links, "node", "left").join(groups, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
        .withColumn("n_links", F.col("copies") - 1 + F.coalesce("partners", F.lit(0))),
        "vector-answers",
    )
    best = stage(answer.groupBy("component").agg(F.min("first").alias("best")), "vector-firsts")
    answer = stage(
        answer.join(best, "component").select("label_key", "dim", "vector", "n_links", F.col("best.vec_id").alias("top")),
        "vector-tops",
    )
    alone = rows.where("not ok").select(
        TAG, "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    linked = rows.where("ok").join(answer, ["label_key", "dim", "vector"]).select(
        TAG, "vec_id", "n_links", F.col("top").alias("component_id")
    )
    return linked.union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )


ship_with_jobs(__name__)
