"""Packing against the tokenizer's own library, and its linear program against plain searches."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from earshot.llm import packing, queries
from tests.llm.helpers import DOCS, EDGES, clashing

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(queries.TOKENIZER)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check_packing(rows, texts, library, capacity):
    """``rows`` hold every id of every text in one piece, sequences have neither gaps nor overlaps."""
    wanted = Counter()
    for (doc_id, text), times in texts.items():
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        for start in range(0, len(ids), capacity):
            part = packed[4 * start:4 * (start + capacity)]
            wanted[doc_id, start, len(part) // 4, zlib.crc32(part), len(ids)] += times
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == wanted
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for spans in held.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end and length > 0
            end += length
        assert end <= capacity
    assert sorted(held) == list(range(len(held)))
    return len(held)


def test_packing_keeps_every_id(spark, library):
    odd = ["<|endoftext|> it's  \n\n x<|endoftext|>", "a" * 700, "日本語" * 900, " " * 5000 + "x", "é" * 301, "\x00\x01", "<|endoftext"]
    odd += ["".join(f"a{chr(c)}b {chr(c)}{chr(c)}1 " for c in range(lo, lo + 128)) for lo in range(0, 0x3000, 128)]
    rows = [(d, t, None, None, None) for d, t, *_ in EDGES] + [(100 + i, t, None, None, None) for i, t in enumerate(odd)]
    rows += [(500 + i, None, None, None, None) for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS).union(spark.read.parquet(f"{FOLDER}/documents.parquet")).repartition(5)
    texts = Counter((r.doc_id, r.text or "") for r in docs.collect())
    for capacity, unit in ((2048, 16), (96, 8), (8, 1)):
        out = packing.pack(clashing(docs), PATH, public_tokenizers.PATTERN, capacity=capacity, unit=unit).collect()
        n = check_packing(out, texts, library, capacity)
        assert n <= 1.06 * sum(r.length for r in out) / capacity + 2
    assert packing.pack(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_sequences_hold_the_ids(spark, library):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    texts = {r.doc_id: r.text for r in docs.collect()}
    packed = packing.pack(docs, PATH, public_tokenizers.PATTERN).cache()
    whole = {r.sequence_id: r for r in packing.sequences(packed, pad_id=9).collect()}
    for r in packed.collect():
        ids = [*library.encode(texts[r.doc_id], add_special_tokens=False).ids, 1][r.start:r.start + r.length]
        assert whole[r.sequence_id].ids[r.offset:r.offset + r.length] == ids
    for r in whole.values():
        assert len(r.ids) == 2048 or len(r.ids) == r.filled and r.filled & (r.filled - 1) == 0
        assert set(r.ids[r.filled:]) <= {9}


def test_query_pads_little(spark):
    out = queries.QUERIES["op12_cutting_stock"](spark, "/root/testdata/sf0.1").collect()
    filled = Counter()
    for r in out:
        filled[r.sequence_id] += r.length
    assert 2048 * len(filled) <= 1.01 * sum(filled.values())


def test_knapsack_by_brute_force():
    dice = random.Random(5)
    for _ in range(40):
        capacity = dice.randrange(1, 9)
        prices = np.array([0.0, *[dice.choice([0, 0.1, 0.3, dice.random()]) for _ in range(capacity)]])
        value, counts = packing.best_pattern(prices, capacity)
        sets = product(*[range(capacity // k + 1) for k in range(1, capacity + 1)])
        best = max(sum(n * prices[k] for k, n in enumerate(s, 1)) for s in sets if sum(n * k for k, n in enumerate(s, 1)) <= capacity)
        assert abs(value - best) < 1e-9 and counts @ np.arange(capacity + 1) <= capacity
        assert abs(counts[1:] @ prices[1:] - value) < 1e-9


def least_sequences(pieces, capacity):
    """Fewest bins by trying every place of every piece."""
    best = len(pieces)

    def put(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(pieces):
            best = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= pieces[i]:
                put(i + 1, [*rooms[:j], rooms[j] - pieces[i], *rooms[j + 1:]])
        put(i + 1, [*rooms, capacity - pieces[i]])

    put(0, [])
    return best


def test_patterns_are_near_the_least(spark):
    dice = random.Random(6)
    for _ in range(30):
        capacity = dice.randrange(3, 12)
        pieces = sorted((dice.randrange(1, capacity + 1) for _ in range(9)), reverse=True)
        demand = np.bincount(pieces, minlength=capacity + 1)
        found = packing.whole_patterns(demand, capacity, gap=0.0)
        assert (sum(c * n for c, n in found) == demand).all()
        assert all(c @ np.arange(capacity + 1) <= capacity for c, _ in found)
        least = least_sequences(pieces, capacity)
        assert least <= sum(n for _, n in found) <= least + 1
        _, uses = packing.solve(demand, capacity, gap=0.0)
        assert uses.sum() <= least + 1e-6


def test_patterns_do_not_grow_with_the_counts():
    dice = np.random.default_rng(7)
    shape = dice.integers(0, 1000, 129)
    shape[0] = 0
    for times in (1, 10**9):
        found = packing.whole_patterns(shape * times, 128)
        assert len(found) < 600
        # the linear program is a lower bound up to the gap; rounding adds at most one sequence per kind
        _, uses = packing.solve(shape * times, 128)
        assert (1 - packing.GAP) * uses.sum() <= sum(n for _, n in found) <= uses.sum() + 128
