"""Packing documents into sequences of fixed length as a cutting-stock problem.

Documents are cut into pieces of the sequence length and one rest. Piece
lengths, rounded up to units, make a histogram of bounded size. A linear
program over patterns (how many pieces of each class share a sequence) is
solved on it by column generation: a knapsack over the classes, valued at the
current prices, finds each new column by dynamic programming. The solution is
rounded down, what is left is filled largest first, and the pieces of a class,
ranked over all tasks, are dealt to the patterns by their ranks.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import TAG, numbered, slices
from earshot.session import ship_with_jobs, stage

CAPACITY = 2048
END_ID = 1
# tokens in a unit of the histogram; a piece counts as its length rounded up to units
UNIT = 16
# column generation ends when no more than this share of the sequences could still be saved
GAP = 1e-4
_TINY = 1e-9
_RANKS = 1 << 50


def read_vocabulary(path: str) -> tuple[list[bytes], dict[str, int]]:
    """Byte strings in the order of their ids, and the special tokens, of a byte-level BPE ``tokenizer.json``.

    In such files a byte that is not printable is written as a letter from
    U+0100 on. Merges must make their tokens in the order of ids.
    """
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = {token["content"]: token["id"] for token in content["added_tokens"]}
    printable = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    others = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    vocabulary = {token: i for token, i in content["model"]["vocab"].items() if token not in special}
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in content["model"]["merges"]]
    if merged != sorted(merged) or sorted(vocabulary.values()) != list(range(len(vocabulary))):
        raise ValueError("merged tokens must follow one another in the order of the merges")
    return [bytes(byte_of[c] for c in token) for token in sorted(vocabulary, key=vocabulary.__getitem__)], special


def cut_pieces(
    docs: DataFrame, tokenizer: str, pattern: str, id_column: str = "doc_id", text_column: str = "text",
    capacity: int = CAPACITY, unit: int = UNIT, end_id: int = END_ID, with_ids: bool = True,
) -> DataFrame:
    """A row per piece of every document: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``ids``.

    ``kind`` is the length in units, rounded up, and ``nth`` counts the pieces
    of a kind within the task ``part``, so a rank over all tasks needs no sort.
    To be stored by the job that makes it. Special tokens that a text spells
    out get their id, as the file's own library does.
    """
    rows = numbered(docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    ))
    kind = rows.schema["doc_id"].dataType.simpleString()
    vocabulary = docs.sparkSession.sparkContext.broadcast(read_vocabulary(tokenizer))
    shared: dict[str, tiktoken.Encoding] = {}

    def encoding() -> tiktoken.Encoding:
        if "it" not in shared:
            tokens, special = vocabulary.value
            ranks = {token: i for i, token in enumerate(tokens)}
            shared["it"] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        return shared["it"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part = encoding(), TaskContext.get().partitionId()
        special = codec.special_tokens_set
        seen = np.zeros(capacity // unit + 2, dtype=np.int64)
        for batch in batches:
            for piece in slices(batch):
                all_ids, tokens = [], []
                for text in piece.column("text").to_pylist():
                    spelled = {s for s in special if s in text}
                    ids = codec.encode_to_numpy(text, allowed_special=spelled, disallowed_special=())
                    all_ids.append(np.append(ids, end_id).astype("<u4"))
                    tokens.append(len(ids) + 1)
                n = -(-np.array(tokens, dtype=np.int64) // capacity)
                owner = np.repeat(np.arange(len(n)), n)
                start = (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * capacity
                total = np.array(tokens, dtype=np.int64)[owner]
                length = np.minimum(total - start, capacity)
                parts = [all_ids[o][s:s + m] for o, s, m in zip(owner, start, length)]
                kinds = -(-length // unit)
                order = np.argsort(kinds, kind="stable")
                firsts = np.flatnonzero(np.diff(kinds[order], prepend=-1))
                within = np.empty(len(order), dtype=np.int64)
                sizes = np.diff(np.append(firsts, len(order)))
                within[order] = np.arange(len(order)) - np.repeat(firsts, sizes)
                nth = within + seen[kinds]
                seen += np.bincount(kinds, minlength=len(seen))
                columns = [
                    piece.column(TAG).take(pa.array(owner)), piece.column("doc_id").take(pa.array(owner)), pa.array(start),
                    pa.array(length), pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()), pa.array(total),
                    pa.array(kinds.astype(np.int32)), pa.array(np.full(len(owner), part, dtype=np.int32)), pa.array(nth),
                ]
                names = [TAG, "doc_id", "start", "length", "ids_crc32", "doc_tokens", "kind", "part", "nth"]
                if with_ids:
                    columns.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = (
        f"{TAG} bigint, doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, kind int, "
        "part int, nth bigint"
    )
    return rows.mapInArrow(run, schema + ", ids array<int>" * with_ids)


def best_pattern(prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable set of kinds that fits: unbounded knapsack, kind k weighing k units."""
    value, taken = np.zeros(capacity + 1), np.zeros(capacity + 1, dtype=np.int64)
    for room in range(1, capacity + 1):
        options = value[room - 1::-1][:room] + prices[1:room + 1]
        kind = int(np.argmax(options))
        if options[kind] > value[room - 1] + 1e-12:
            value[room], taken[room] = options[kind], kind + 1
        else:
            value[room] = value[room - 1]
    counts = np.zeros(capacity + 1, dtype=np.int64)
    room = capacity
    while room:
        counts[taken[room]] += taken[room] > 0
        room -= max(1, int(taken[room]))
    return float(value[capacity]), counts


def solve(demand: np.ndarray, capacity: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows, counts of every kind) and how often the linear program uses each.

    ``demand`` counts the pieces of kinds 0 (none) to ``capacity``. Revised
    simplex on the patterns known so far; a lower bound comes from the prices
    scaled until no pattern is worth more than one sequence.
    """
    kinds = np.flatnonzero(demand)
    patterns = np.zeros((len(kinds), capacity + 1), dtype=np.int64)
    patterns[np.arange(len(kinds)), kinds] = capacity // kinds
    inverse = np.diag(1.0 / (capacity // kinds))
    wanted = demand[kinds].astype(float)
    uses = inverse @ wanted
    bound = float((kinds * wanted).sum()) / capacity
    while len(kinds):
        prices = inverse.sum(axis=0)
        full = np.zeros(capacity + 1)
        full[kinds] = np.maximum(prices, 0.0)
        value, counts = best_pattern(full, capacity)
        bound = max(bound, float(full[kinds] @ wanted) / max(value, 1.0))
        if value <= 1.0 + _TINY or uses.sum() - bound <= gap * uses.sum():
            break
        column = inverse @ counts[kinds].astype(float)
        ratios = np.where(column > _TINY, uses / np.where(column > _TINY, column, 1.0), np.inf)
        out = int(np.argmin(ratios))
        step = ratios[out]
        inverse[out] /= column[out]
        uses = np.maximum(uses - step * column, 0.0)
        uses[out] = step
        column[out] = 0.0
        inverse -= np.outer(column, inverse[out])
        patterns[out] = counts
    return patterns, uses


def whole_patterns(demand: np.ndarray, capacity: int, gap: float = GAP) -> list[tuple[np.ndarray, int]]:
    """Patterns and whole numbers of uses that together hold exactly ``demand``.

    The solution rounded down; what is left is filled largest first, each such
    pattern as often as the rest allows, so there are few of them at any size.
    """
    rest = demand.astype(np.int64).copy()
    found = []

    def take(counts: np.ndarray, most: int) -> None:
        held = np.flatnonzero(counts)
        times = min(most, int((rest[held] // counts[held]).min()))
        if times > 0:
            found.append((counts, times))
            rest[held] -= counts[held] * times

    patterns, uses = solve(demand, capacity, gap)
    for i in np.argsort(-uses, kind="stable"):
        take(patterns[i], int(uses[i] + 1e-6))
    while rest.any():
        counts, room = np.zeros_like(rest), capacity
        for kind in np.flatnonzero(rest)[::-1]:
            counts[kind] = min(rest[kind], room // kind)
            room -= counts[kind] * kind
        take(counts, int(rest.max()))
    return found


def deal(found: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, ...]:
    """For every kind, from which rank on its pieces go to which sequences: key, first rank, sequences, first sequence."""
    keys, firsts, times_, bases = [], [], [], []
    reached: dict[int, int] = {}
    base = 0
    for counts, times in found:
        for kind in np.flatnonzero(counts).tolist():
            first = reached.get(kind, 0)
            keys.append(kind * _RANKS + first)
            firsts.append(first)
            times_.append(times)
            bases.append(base)
            reached[kind] = first + int(counts[kind]) * times
        base += times
    order = np.argsort(np.array(keys, dtype=np.int64))
    return tuple(np.array(column, dtype=np.int64)[order] for column in (keys, firsts, times_, bases))


def pack(
    docs: DataFrame, tokenizer: str, pattern: str, id_column: str = "doc_id", text_column: str = "text",
    capacity: int = CAPACITY, unit: int = UNIT, end_id: int = END_ID, with_ids: bool = True, gap: float = GAP,
) -> DataFrame:
    """All documents in sequences of at most ``capacity`` tokens, a row per piece.

    Returns ``doc_id``, ``start`` (the document's ids before the piece),
    ``length``, ``ids_crc32``, ``doc_tokens`` (with the end id),
    ``sequence_id`` (0, 1, …), ``offset`` (in the sequence, without gaps) and
    ``ids`` if asked for. ``tokenizer`` is a byte-level BPE ``tokenizer.json``,
    read on the driver; ``capacity`` must be a multiple of ``unit``.

    The linear program sees ``capacity / unit`` numbers at any size of the
    data. Null texts count as empty and hold the end id alone; very long texts
    become many pieces; equal lengths are told apart by their ranks; repeated
    rows and null ids are documents like any other; further columns are not
    looked at, whatever their names. An empty table gives no rows.
    """
    if capacity % unit:
        raise ValueError("capacity must be a multiple of unit")
    pieces = stage(
        cut_pieces(docs, tokenizer, pattern, id_column, text_column, capacity, unit, end_id, with_ids), "pack-pieces"
    )
    counts = stage(pieces.groupBy("part", "kind").agg(F.count("*").alias("n")), "pack-counts")
    histogram = counts.groupBy("kind").agg(F.sum("n").alias("n")).collect()
    demand = np.zeros(capacity // unit + 1, dtype=np.int64)
    for row in histogram:
        demand[row.kind] = row.n
    keys, firsts, times, bases = deal(whole_patterns(demand, capacity // unit, gap))
    before = Window.partitionBy("kind").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("part", "kind", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    ranked = pieces.join(ahead, ["part", "kind"]).withColumn("rank", F.col("ahead") + F.col("nth"))
    names = [TAG, "doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
    ranked = ranked.select(*names, "kind", "rank")
    types = dict(ranked.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, batch.column("kind").to_numpy().astype(np.int64) * _RANKS + rank, side="right") - 1
            sequence = bases[at] + (rank - firsts[at]) % times[at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence)], names=[*names, "sequence_id"]
            )

    dealt = ranked.mapInArrow(run, ", ".join(f"{n} {types[n]}" for n in names) + ", sequence_id bigint")
    earlier = Window.partitionBy("sequence_id").orderBy(TAG, "start").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0))).drop(TAG)


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """``sequence_id``, ``ids`` and the number of tokens ``filled`` of every sequence of ``pack(..., with_ids=True)``.

    Padded to ``capacity`` unless the tokens are a power of two.
    """
    rows = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    ids = F.flatten(F.transform("parts", lambda part: part["ids"]))
    filled = F.size("tokens")
    padding = F.when(F.bit_count(filled) == 1, 0).otherwise(capacity - filled)
    return rows.select("sequence_id", ids.alias("tokens")).select(
        "sequence_id", F.concat("tokens", F.array_repeat(F.lit(pad_id), padding)).alias("ids"), filled.alias("filled")
    )


ship_with_jobs(__name__)
