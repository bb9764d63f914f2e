"""What each of several document filters removes, in every order of application.

One finite-state pass over the bytes of a text finds its words, capitals, code
points and symbols. Its tables give every byte a class, and every state and
class the next state and the marks to write. The spans of words it marks go
into a hash table that compares their bytes, which counts the distinct ones.
Five conditions of a document make a mask of 32 values; all orders of the
filters are worked out from how often each mask occurs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import slices
from earshot.session import ship_with_jobs, stage

LETTERS = "ABCDE"
# conditions under which a document fails: see ``filter_marks``
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 2
SYMBOLS = b"#$%&*|"
WORD_SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"

# classes of bytes
_SPACE, _CAPITAL, _SYMBOL, _TAIL, _OTHER = range(5)
# states: outside and inside a word
_OUT, _IN = 0, 1
# marks the transducer writes, as bits
_STARTS, _ENDS, _UPPER, _SIGN, _POINT = 1, 2, 4, 8, 16
# spans up to this many bytes are hashed eight bytes at a time, all together
_LANES = 8


def byte_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class of every byte, next state by (state, class) and marks by (state, class).

    A tail byte (10xxxxxx) goes on with a code point, every other byte begins
    one. The next state depends on the class alone, so the state before each
    byte is known from the byte before it and a whole block is passed at once.
    """
    classes = np.full(256, _OTHER, dtype=np.uint8)
    classes[0x80:0xC0] = _TAIL
    classes[ord("A"):ord("Z") + 1] = _CAPITAL
    classes[list(SYMBOLS)] = _SYMBOL
    classes[list(WORD_SPACES)] = _SPACE
    following = np.full((2, 5), _IN, dtype=np.uint8)
    following[:, _SPACE] = _OUT
    marks = np.full((2, 5), _POINT, dtype=np.uint8)
    marks[:, _TAIL] = 0
    marks[:, _CAPITAL] |= _UPPER
    marks[:, _SYMBOL] |= _SIGN
    marks[_OUT] |= np.where(np.arange(5) != _SPACE, _STARTS, 0).astype(np.uint8)
    marks[_IN, _SPACE] |= _ENDS
    return classes, following, marks


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def _distinct(data: bytes, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, n_owners: int) -> np.ndarray:
    """Number of different byte strings among the spans of each owner.

    Spans are put into an open-addressed table. A span that finds a slot taken
    is the same word only if owner, length and all bytes agree with the span
    there; else it goes on to the next slot.
    """
    padded = data + bytes(8)
    eight = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    lengths = ends - starts
    covered = np.minimum(lengths, 8)
    cut = ((np.uint64(64) - covered.astype(np.uint64) * np.uint64(8)))
    first = eight[starts] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> cut)
    hashes = _mixed(first ^ (lengths.astype(np.uint64) << np.uint64(56)))
    longer = np.flatnonzero(lengths > 8)
    for lane in range(1, _LANES):
        # the last eight bytes of a span may overlap those before
        longer = longer[lengths[longer] > 8 * lane]
        if not len(longer):
            break
        at = np.minimum(starts[longer] + 8 * lane, ends[longer] - 8)
        hashes[longer] = _mixed(hashes[longer] * np.uint64(31) + eight[at])
    for i in np.flatnonzero(lengths > 8 * _LANES):
        hashes[i] = xxhash.xxh64_intdigest(data[starts[i]:ends[i]])
    hashes = _mixed(hashes + owner.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    mask = (1 << max(4, int(2 * len(starts)).bit_length())) - 1
    table = np.full(mask + 1, -1, dtype=np.int64)
    slot = (hashes & np.uint64(mask)).astype(np.int64)
    waiting = np.arange(len(starts))
    counts = np.zeros(n_owners, dtype=np.int64)
    while len(waiting):
        at = slot[waiting]
        free = table[at] < 0
        table[at[free]] = waiting[free]
        there = table[at]
        mine = there == waiting
        counts += np.bincount(owner[waiting[mine]], minlength=n_owners)
        waiting, there = waiting[~mine], there[~mine]
        same = (hashes[waiting] == hashes[there]) & (owner[waiting] == owner[there])
        same &= (lengths[waiting] == lengths[there]) & (first[waiting] == first[there])
        for i in np.flatnonzero(same & (lengths[waiting] > 8 * _LANES)):
            a, b = waiting[i], there[i]
            same[i] = data[starts[a]:ends[a]] == data[starts[b]:ends[b]]
        check = np.flatnonzero(same & (lengths[waiting] > 8) & (lengths[waiting] <= 8 * _LANES))
        for lane in range(1, _LANES):
            check = check[lengths[waiting[check]] > 8 * lane]
            if not len(check):
                break
            a, b = waiting[check], there[check]
            equal = eight[np.minimum(starts[a] + 8 * lane, ends[a] - 8)] == eight[np.minimum(starts[b] + 8 * lane, ends[b] - 8)]
            same[check[~equal]] = False
            check = check[equal]
        waiting = waiting[~same]
        slot[waiting] = (slot[waiting] + 1) & mask
    return counts


def count_marks(texts: list[bytes]) -> dict[str, np.ndarray]:
    """``words``, ``distinct``, ``capitals``, ``points`` and ``symbols`` of every text, in one pass over all."""
    n = len(texts)
    # a space after every text ends its last word; it is taken off the code points again
    data = b" ".join([*texts, b""])
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=n) + 1
    first = np.cumsum(sizes) - sizes
    if not n:
        return {name: np.zeros(0, dtype=np.int64) for name in ("words", "distinct", "capitals", "points", "symbols")}
    classes, following, marks = byte_tables()
    kinds = classes[np.frombuffer(data, dtype=np.uint8)]
    before = np.empty(len(kinds), dtype=np.uint8)
    before[0] = _OUT
    before[1:] = following[0][kinds[:-1]]
    written = marks.ravel()[before * np.uint8(5) + kinds]
    starts = np.flatnonzero(written & _STARTS)
    ends = np.flatnonzero(written & _ENDS)
    owner = np.searchsorted(first, starts, side="right") - 1

    def total(mark: int) -> np.ndarray:
        return np.add.reduceat((written & mark) != 0, first, dtype=np.int64)

    return {
        "words": np.bincount(owner, minlength=n), "distinct": _distinct(data, starts, ends, owner, n),
        "capitals": total(_UPPER), "points": total(_POINT) - 1, "symbols": total(_SIGN),
    }


def filter_marks(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source",
    with_counts: bool = True,
) -> DataFrame:
    """``doc_id``, ``part``, ``digest`` of the text and ``fails``, the filters A to D it fails as bits.

    Bit 0 (A): under 200 words. Bit 1 (B): fewer than half of the words are
    distinct. Bit 2 (C): over 2 % of the code points are ``A-Z``. Bit 3 (D):
    holds one of the symbols. Null texts count as empty, null parts as the
    empty string. ``with_counts`` adds the counts behind the bits.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["words", "distinct", "capitals", "points", "symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                texts = [t.as_buffer().to_pybytes() for t in piece.column("text")]
                c = count_marks(texts)
                fails = (c["words"] < LEAST_WORDS) * 1
                fails |= (100 * c["distinct"] < LEAST_DISTINCT_PERCENT * c["words"]) * 2
                fails |= (100 * c["capitals"] > MOST_CAPITALS_PERCENT * c["points"]) * 4
                fails |= (c["symbols"] > 0) * 8
                digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
                columns = [piece.column("doc_id"), piece.column("part"), digests, pa.array(fails, pa.int32())]
                columns += [pa.array(c[name], pa.int64()) for name in names if with_counts]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "part", "digest", "fails", *(names if with_counts else [])]
                )

    schema = f"doc_id {kind}, part string, digest binary, fails int"
    return rows.mapInArrow(run, schema + "".join(f", {name} bigint" for name in names if with_counts))


def with_copies(marked: DataFrame) -> DataFrame:
    """Sets bit 4 (E) in ``fails`` of rows whose text a row with a smaller id has too.

    Null ids come after all others. Rows that share both text and smallest id
    are not copies of one another. Only the smallest id of a text is joined
    back, with the id as part of the key, so a text that very many rows share
    is not gathered anywhere.
    """
    missing = F.col("doc_id").isNull()
    firsts = stage(
        marked.groupBy("digest").agg(F.min(F.struct(missing.alias("missing"), "doc_id")).alias("first")), "audit-firsts"
    ).select(F.col("digest").alias("d"), F.col("first.doc_id").alias("i"), F.lit(True).alias("is_first"))
    same = marked["digest"].eqNullSafe(firsts["d"]) & marked["doc_id"].eqNullSafe(firsts["i"])
    copy = F.when(F.col("is_first"), 0).otherwise(1 << 4)
    return marked.join(firsts, same, "left").withColumn("fails", F.col("fails").bitwiseOR(copy)).drop("d", "i", "is_first")


def _over_masks(counts: str, condition: str, factor: str = "1") -> Column:
    return F.expr(
        f"aggregate(sequence(1, {2 ** len(LETTERS)}), 0L, (a, i) -> a + "
        f"IF({condition.replace('mask', '(i - 1)')}, {counts}[i - 1] * ({factor.replace('mask', '(i - 1)')}), 0L))"
    )


def all_orders(masks: DataFrame) -> DataFrame:
    """A row per part, order and step from ``part``, ``fails``, ``n``, ``good`` and ``toxic`` counts.

    A filter removes a document that fails it and none of the filters before
    it. Over all orders a document that fails f filters is removed by each of
    them in 1/f of the orders, which gives ``shapley``.
    """
    cells = [
        F.expr("array(" + ", ".join(f"sum(IF(fails = {m}, {name}, 0L))" for m in range(2 ** len(LETTERS))) + ")").alias(name)
        for name in ("n", "good", "toxic")
    ]
    orders = F.split(F.lit(" ".join(map("".join, permutations(LETTERS)))), " ")
    bit = "shiftleft(1, instr('%s', substring(filter_order, %%s, 1)) - 1)" % LETTERS
    shares = factorial(len(LETTERS))
    removed = "(mask & own) <> 0 AND (mask & before) = 0"
    rows = (
        masks.groupBy("part").agg(*cells)
        .withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))))
        .withColumn("own", F.expr(bit % "step"))
        .withColumn("before", F.expr(f"aggregate(sequence(1, step), 0, (a, i) -> a + IF(i < step, {bit % 'i'}, 0))"))
    )
    return rows.select(
        "part", "filter_order", "step", _over_masks("n", "(mask & (own | before)) = 0").alias("kept"),
        _over_masks("n", removed).alias("removed"),
        _over_masks("n", "(mask & own) <> 0 AND (mask & before) <> 0").alias("redundant"),
        F.col("n")[F.col("own")].alias("unique_fails"), _over_masks("good", removed).alias("good_lost"),
        _over_masks("toxic", removed).alias("toxic_lost"),
        _over_masks("n", "(mask & own) <> 0", f"{shares} DIV bit_count(mask)").alias("shapley"),
    )


def audit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source"
) -> DataFrame:
    """What every filter does at every step of every order, per part.

    Returns ``part``, ``filter_order`` (all 120), ``step`` (1 to 5) and the
    counts ``kept``, ``removed``, ``redundant``, ``unique_fails``,
    ``good_lost``, ``toxic_lost`` and ``shapley``. ``labels`` holds the ids
    with ``quality`` and ``toxic``, 1 or not; where an id has several rows,
    one with 1 is enough, and null ids have no label. Null texts count as
    empty, null parts as the empty string; very long texts are read whole;
    repeated rows count as often as they occur (``with_copies`` says which of
    them are copies); further columns are not looked at, whatever their names.
    An empty table has no parts and gives no rows.
    """
    marked = stage(filter_marks(docs, id_column, text_column, part_column, with_counts=False), "audit-marks")
    known = labels.select(
        F.col(id_column).alias("id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")
    ).where("id IS NOT NULL").groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    full = with_copies(marked)
    full = full.join(stage(known, "audit-labels"), full["doc_id"] == F.col("id"), "left")
    masks = full.groupBy("part", "fails").agg(
        F.count("*").alias("n"), F.count_if(F.col("good")).alias("good"), F.count_if(F.col("toxic")).alias("toxic")
    )
    return all_orders(masks)


ship_with_jobs(__name__)
