"""Near-duplicates by SimHash, found with multi-index hashing.

A fingerprint is cut into two segments. Of two fingerprints with at most three
different bits, one segment differs in at most one bit. So the table holds
each segment as it is, and every fingerprint asks for its segments and for
those with one set bit cleared; the partner with the bit cleared is met from
the side that has it set. What meets under a segment value is verified on all
64 bits. Equal fingerprints are one entry, and a value hands on a spanning set
of its links, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import TAG, slices, tagged, untagged
from earshot.llm.components import connected_components, over_groups, roots_of_pairs, split_hot
from earshot.session import ship_with_jobs, stage

SHINGLE = 3
SEED = 42
RADIUS = 3
# values with more fingerprints than this are compared block by block
CAP = 4096
# runs of up to this length are compared together, longer ones one by one
_SHORT = 32


def fingerprint(text: str, words_per_shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bits set in over half the hashes of the shingles of ``text``; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= words_per_shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*[words[i:] for i in range(words_per_shingle)])))
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for start in range(0, len(shingles), 8192):
        part = shingles[start:start + 8192]
        hashes = np.array([digest(s, seed) for s in part], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(shingles), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 words_per_shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``row_tag``, ``doc_id`` and the fingerprint ``fp`` as a signed 64-bit number."""
    texts = docs.select(TAG, F.col(id_column).alias("doc_id"),
                        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                prints = [fingerprint(t, words_per_shingle, seed) for t in part.column("text").to_pylist()]
                signed = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column(TAG), part.column("doc_id"), signed], names=[TAG, "doc_id", "fp"]
                )

    return texts.mapInArrow(run, f"{TAG} bigint, doc_id {kind}, fp bigint")


def _entries(prints: DataFrame) -> DataFrame:
    """A row per segment value under which a fingerprint is stored or asks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for segment in (0, 1):
                value = (fp >> np.uint64(32 * segment)) & np.uint64(0xFFFFFFFF)
                mark = np.uint64(segment << 32)
                keys, owners, exact = [value | mark], [fp], [np.ones(len(fp), dtype=bool)]
                for bit in range(32):
                    has = np.flatnonzero((value >> np.uint64(bit)) & np.uint64(1))
                    keys.append(value[has] ^ np.uint64(1 << bit) | mark)
                    owners.append(fp[has])
                    exact.append(np.zeros(len(has), dtype=bool))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(owners).view(np.int64)),
                     pa.array(np.concatenate(exact))], names=["value", "fp", "stored"],
                )

    return prints.mapInArrow(run, "value bigint, fp bigint, stored boolean")


def _linked(fp: np.ndarray, stored: np.ndarray, radius: int) -> np.ndarray:
    """Roots within one long run, from its rows of the distance matrix a few at a time."""
    roots = np.arange(len(fp))
    step = max(1, (1 << 21) // len(fp))
    while True:
        new = roots.copy()
        for start in range(0, len(fp), step):
            part = slice(start, start + step)
            near = np.bitwise_count(fp[part, None] ^ fp[None, :]) <= radius
            near &= stored[part, None] | stored[None, :]
            new[part] = np.minimum(new[part], np.where(near, roots[None, :], len(fp)).min(axis=1))
        np.minimum.at(new, roots, new.copy())
        new = new[new]
        if (new == roots).all():
            return roots
        roots = new


def near_links(prints: DataFrame, radius: int = RADIUS, cap: int = CAP) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints ``fp`` (distinct) within ``radius``, at most 3."""
    if not 0 <= radius <= 3:
        raise ValueError("two segments with balls of one bit find up to three differing bits")

    def verify(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch | None:
        fp = table.column("fp").to_numpy().view(np.uint64)
        stored = table.column("stored").to_numpy()
        lengths = np.diff(starts)
        roots = np.arange(len(fp))
        end = np.repeat(starts[1:], lengths)
        short = np.repeat((lengths <= _SHORT) & (np.add.reduceat(stored, starts[:-1]) > 0), lengths)
        lefts, rights = [], []
        place = np.flatnonzero(short)
        for distance in range(1, _SHORT):
            place = place[place + distance < end[place]]
            if not len(place):
                break
            other = place + distance
            near = np.bitwise_count(fp[place] ^ fp[other]) <= radius
            near &= stored[place] | stored[other]
            lefts.append(place[near])
            rights.append(other[near])
        if lefts:
            roots = roots_of_pairs(len(fp), np.concatenate(lefts), np.concatenate(rights))
        for run in np.flatnonzero(lengths > _SHORT):
            part = slice(starts[run], starts[run + 1])
            if stored[part].any():
                roots[part] = starts[run] + _linked(fp[part], stored[part], radius)
        moved = np.flatnonzero((roots != np.arange(len(fp))) & (fp != fp[roots]))
        if not len(moved):
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(fp[moved].view(np.int64)), pa.array(fp[roots[moved]].view(np.int64))], names=["a", "b"]
        )

    met = split_hot(_entries(prints), "value", "fp", cap)
    return over_groups(met.drop("own"), ["value", "lo", "hi"], verify, "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words_per_shingle: int = SHINGLE,
    seed: int = SEED, radius: int = RADIUS, cap: int = CAP, has_tags: bool = False,
) -> DataFrame:
    """``row_tag``, ``doc_id``, ``fp``, ``component_id`` and ``kept`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most
    ``radius`` different bits; one row of each component, with that id, is
    ``kept``. Null, empty and blank texts have fingerprint 0 and link like any
    other; rows with null ids take part and come after all others. An empty
    table gives no rows.
    """
    source = docs if has_tags else tagged(docs.select(id_column, text_column), "simhash-input")
    rows = stage(fingerprints(source, id_column, text_column, words_per_shingle, seed), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", TAG)).alias("first")
    prints = stage(rows.groupBy("fp").agg(first), "distinct-fingerprints")
    groups = connected_components(stage(near_links(prints.select("fp"), radius, cap), "near-links"))
    with_group = prints.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    with_group = stage(with_group, "fingerprint-groups")
    best = stage(with_group.groupBy("component").agg(F.min("first").alias("best")), "group-firsts")
    answer = stage(with_group.join(best, "component").select("fp", "best"), "fingerprint-answers")
    return rows.join(answer, "fp").select(
        TAG, "doc_id", "fp", F.col("best.doc_id").alias("component_id"), (F.col(TAG) == F.col(f"best.{TAG}")).alias("kept")
    )


def drop_near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, all its columns kept."""
    source = tagged(docs, "simhash-docs")
    kept = near_duplicates(source, id_column, text_column, has_tags=True, **options).where("kept").select(TAG)
    return untagged(source.join(kept, TAG, "left_semi"), docs)


ship_with_jobs(__name__)
