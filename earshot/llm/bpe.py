"""Byte-level BPE, encoding and decoding with numpy.

Distinct matches of the split pattern are laid out in padded matrices by
length. In every round each row merges its leftmost pair of least rank; only
the pairs beside the merge are looked up again, in a hash table of all pairs
that make a token, and finished rows leave the matrix.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import slices
from earshot.session import ship_with_jobs

# longer matches are merged with a heap, by the same rule: a matrix would cost the square of their length
LONGEST_ROW = 256
# rows of a matrix, and matches a worker remembers
ROWS = 1 << 15
REMEMBERED = 300_000
_NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a ``.tiktoken`` file in the order of their ids."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    return sorted(ranks, key=ranks.__getitem__)


class PairTable:
    """Open-addressed table from a pair of ids to the id their bytes make together."""

    def __init__(self, tokens: list[bytes]):
        rank = {token: i for i, token in enumerate(tokens)}
        keys, values = [], []
        for i, token in enumerate(tokens):
            for cut in range(1, len(token)):
                left, right = rank.get(token[:cut]), rank.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(i)
        key, value = np.array(keys, dtype=np.int64), np.array(values, dtype=np.int32)
        self.bits = max(4, int(len(key) * 4).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, _NONE, dtype=np.int32)
        slot = self._slot(key)
        left = np.arange(len(key))
        while len(left):
            free = left[self.keys[slot[left]] == -1]
            _, winners = np.unique(slot[free], return_index=True)
            placed = free[winners]
            self.keys[slot[placed]], self.values[slot[placed]] = key[placed], value[placed]
            left = np.setdiff1d(left, placed, assume_unique=True)
            taken = self.keys[slot[left]] != -1
            slot[left[taken]] = (slot[left[taken]] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids, ``_NONE`` where there is no such token or a side is below 0."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        key[(left < 0) | (right < 0)] = -2
        shape, key = key.shape, key.ravel()
        slot = self._slot(key)
        found = np.where(self.keys[slot] == key, self.values[slot], _NONE)
        open_ = np.flatnonzero((self.keys[slot] != key) & (self.keys[slot] != -1) & (key >= 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            at = self.keys[slot[open_]]
            hit = at == key[open_]
            found[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (at != -1)]
        return found.reshape(shape)


class Codec:
    def __init__(self, tokens: list[bytes], pattern: str):
        self.pairs = PairTable(tokens)
        self.pattern = regex.compile(pattern)
        self.of_byte = np.full(256, -1, dtype=np.int32)
        for i, token in enumerate(tokens):
            if len(token) == 1:
                self.of_byte[token[0]] = i
        if (self.of_byte < 0).any():
            raise ValueError("every single byte must be a token")
        self.whole = {token: i for i, token in enumerate(tokens)}
        self.flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.known: dict[str, bytes] = {}

    def _merge_rows(self, pieces: list[bytes]) -> list[bytes]:
        """Ids, packed as little-endian 32 bits, of pieces of similar length."""
        lengths = np.array([len(p) for p in pieces])
        width = int(lengths.max())
        ids = np.full((len(pieces), width), -1, dtype=np.int32)
        inside = np.arange(width) < lengths[:, None]
        ids[inside] = self.of_byte[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        rank = np.full((len(pieces), width), _NONE, dtype=np.int32)
        rank[:, :-1] = self.pairs.find(ids[:, :-1], ids[:, 1:])
        out: list[bytes] = [b""] * len(pieces)
        origin = np.arange(len(pieces))
        columns = np.arange(width)
        while True:
            place = rank.argmin(axis=1)
            rows = np.arange(len(origin))
            best = rank[rows, place]
            ended = best == _NONE
            if ended.any():
                for row in np.flatnonzero(ended):
                    line = ids[row]
                    out[origin[row]] = line[line >= 0].astype("<u4").tobytes()
                going = ~ended
                ids, rank, origin, place, best = ids[going], rank[going], origin[going], place[going], best[going]
                if not len(origin):
                    return out
                rows = np.arange(len(origin))
            ids[rows, place] = best
            source = np.minimum(columns + (columns > place[:, None]), width - 1)
            ids = np.take_along_axis(ids, source, axis=1)
            rank = np.take_along_axis(rank, source, axis=1)
            ids[:, -1], rank[:, -1] = -1, _NONE
            after = np.minimum(place + 1, width - 1)
            rank[rows, place] = np.where(
                place + 1 < width, self.pairs.find(ids[rows, place], ids[rows, after]), _NONE
            )
            before = np.maximum(place - 1, 0)
            rank[rows, before] = np.where(
                place > 0, self.pairs.find(ids[rows, before], ids[rows, place]), rank[rows, before]
            )

    def _merge_long(self, piece: bytes) -> bytes:
        """The same merges for one long piece: least rank first, leftmost first."""
        ids = self.of_byte[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks = self.pairs.find(np.array(ids[:-1], dtype=np.int32), np.array(ids[1:], dtype=np.int32)).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(ranks) if r != _NONE]
        heapq.heapify(heap)
        alive = [True] * n

        def push(i: int, j: int) -> None:
            token = self.whole.get(self._bytes(ids[i]) + self._bytes(ids[j]))
            if token is not None:
                heapq.heappush(heap, (token, i, ids[i], ids[j]))

        while heap:
            merged, i, left, right = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or ids[i] != left or ids[j] != right:
                continue
            ids[i] = merged
            alive[j] = False
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                push(i, after[i])
            if before[i] >= 0:
                push(before[i], i)
        return np.array([x for x, keep in zip(ids, alive) if keep], dtype="<u4").tobytes()

    def _bytes(self, i: int) -> bytes:
        return self.flat[self.starts[i]:self.starts[i] + self.lengths[i]].tobytes()

    def learn(self, matches: set[str]) -> None:
        """Encodes matches that are not known yet."""
        new = [m for m in matches if m not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = list(matches)
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for match in new:
            piece = match.encode("utf-8")
            token = self.whole.get(piece)
            if token is not None:
                self.known[match] = token.to_bytes(4, "little")
            elif len(piece) > LONGEST_ROW:
                self.known[match] = self._merge_long(piece)
            else:
                by_length.setdefault(-(-len(piece) // 4), []).append((match, piece))
        for bucket in by_length.values():
            for start in range(0, len(bucket), ROWS):
                part = bucket[start:start + ROWS]
                for (match, _), packed in zip(part, self._merge_rows([p for _, p in part])):
                    self.known[match] = packed

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, packed as little-endian 32 bits."""
        matches = [self.pattern.findall(text) for text in texts]
        self.learn(set().union(*matches) if matches else set())
        known = self.known
        return [b"".join([known[m] for m in found]) for found in matches]

    def decode(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, dtype="<u4").astype(np.int64)
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ids):
            return b""
        place = np.arange(ends[-1]) + np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.flat[place].tobytes()


def encode(
    docs: DataFrame, vocabulary: str, pattern: str, id_column: str = "doc_id", text_column: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """``doc_id``, ``n_tokens``, hashes of the ids and of the decoded bytes, and the ``ids`` if asked for.

    ``vocabulary`` names a ``.tiktoken`` file, read on the driver and sent to
    the tasks. ``ids_sha256`` is taken over the ids as little-endian unsigned
    32-bit integers, ``decoded_sha256`` over the bytes decoded from the ids.
    Null counts as the empty text, which has no ids. Rows are independent:
    repeated rows give repeated results, null ids stay null, and an empty
    table gives no rows.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    tokens = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    shared: dict[str, Codec] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.get("codec") or shared.setdefault("codec", Codec(tokens.value, pattern))
        for batch in batches:
            for part in slices(batch):
                packed = codec.encode(part.column("text").to_pylist())
                columns = [
                    part.column("doc_id"),
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                    pa.array([hashlib.sha256(codec.decode(p)).hexdigest() for p in packed], pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(p, dtype="<u4") for p in packed], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, schema + ", ids array<bigint>" * with_ids)


ship_with_jobs(__name__)
