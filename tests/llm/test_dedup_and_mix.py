import hashlib
import re
from collections import Counter, defaultdict

import corpus_pipeline
from earshot import session
from earshot.llm import exact_dedup, mixing, sharding
from tests.llm.helpers import DOCS, EDGES, clashing, edge_table, split_words


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_exact_dedup_of_edges(spark):
    for table in (edge_table(spark), clashing(edge_table(spark))):
        rows = exact_dedup.duplicate_groups(table, runs=8, fan=2).collect()
        groups = defaultdict(list)
        for doc_id, text, *_ in EDGES:
            groups[normal(text)].append(doc_id)
        assert len(rows) == len(EDGES)
        by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
        for row in rows:
            ids = by_sha[row.text_sha256]
            known = [i for i in ids if i is not None]
            assert row.group_size == len(ids) and row.keep_id == (min(known) if known else None)
        assert Counter(r.text_sha256 for r in rows if r.kept) == Counter(by_sha.keys())


def test_drop_duplicates_keeps_columns_and_one_of_each(spark):
    kept = exact_dedup.drop_duplicates(clashing(edge_table(spark)))
    assert set(edge_table(spark).columns) <= set(kept.columns)
    assert sorted(normal(r.text) for r in kept.collect()) == sorted({normal(t) for _, t, *_ in EDGES})


def test_hot_group_over_many_runs(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}", "en", "s", 1) for i in range(600)]
    out = exact_dedup.duplicate_groups(spark.createDataFrame(rows, DOCS), runs=27, fan=3).collect()
    hot = [r for r in out if r.group_size > 1]
    assert len(hot) == 400 and {r.keep_id for r in hot} == {1} and sum(r.kept for r in out) == 201


def targets(sizes, weights=(5, 2, 1)):
    """Water filling, source by source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = 1.5 * sum(sizes.values())
    full, open_ = {}, set(order)
    while True:
        rest = total - sum(full.values())
        level = rest / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if weight[s] * level > 2 * sizes[s]}
        if not over:
            return {s: full.get(s, weight[s] * level) for s in order}
        for s in over:
            full[s] = 2.0 * sizes[s]
        open_ -= over


def check_mix(rows, docs):
    sizes = Counter()
    for doc_id, text, _, source, *_ in docs:
        sizes[source] += len(split_words(text))
    expected = targets(sizes)
    source_of = {d[0]: d[3] for d in docs}
    taken, largest = Counter(), Counter()
    for row in rows:
        source = source_of[row.doc_id]
        assert row.source_size == sizes[source] and abs(row.target - expected[source]) < 1e-6
        assert row.taken in (0, row.size, 2 * row.size)
        taken[source] += row.taken
        largest[source] = max(largest[source], row.size)
    for source in sizes:
        assert abs(taken[source] - expected[source]) <= largest[source] / 2 + 1e-6


def test_mix_meets_targets(spark):
    docs = [(i, "w " * (i % 17), "en", None if i % 7 == 6 else f"s{i % 3}" if i % 2 else "s0", 1) for i in range(900)]
    check_mix(mixing.mix(spark.createDataFrame(docs, DOCS)).collect(), docs)


def test_mix_of_edges_and_no_rows(spark):
    rows = mixing.mix(clashing(edge_table(spark))).collect()
    assert len(rows) == len(EDGES) and all(r.taken <= 2 * r.size for r in rows)
    assert mixing.mix(edge_table(spark).limit(0)).count() == 0
    repeated = mixing.mixed(edge_table(spark))
    assert repeated.columns == edge_table(spark).columns
    taken = mixing.mix(edge_table(spark)).agg({"taken": "sum"}).first()[0]
    assert sum(len(split_words(r.text)) for r in repeated.collect()) == taken


def test_shards(spark):
    rows = [(i, f"text number {i} " * (i % 40 + 1), None, None, None) for i in range(3000)]
    rows += [(10_000 + i, "copies of one text", None, None, None) for i in range(500)]
    rows += [(20_000 + i, "a text larger than a shard " * 20, None, None, None) for i in range(3000)]
    out = sharding.shard(spark.createDataFrame(rows, DOCS)).collect()
    assert len(out) == len(rows)
    sizes, slots, shards_of = Counter(), defaultdict(list), defaultdict(set)
    for r in out:
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        shards_of[r.key].add(r.shard)
    assert set(sizes) == set(range(16))
    assert max(sizes.values()) <= 1.05 * min(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(len(s) > 1 for s in shards_of.values()) == 1


def test_units_are_bounded_by_rows(spark):
    rows = [(i, "" if i % 3 == 0 else f"text number {i} " * 20, None, None, None) for i in range(12_000)]
    out = sharding.shard(spark.createDataFrame(rows, DOCS), ranges=64)
    path = [p for p in session._staged_paths if "/shard-units-" in p][-1]
    counts = [r["count"] for r in spark.read.parquet(path).groupBy("unit").count().collect()]
    assert max(counts) <= 3 * len(rows) / 64
    slots = defaultdict(list)
    for r in out.collect():
        slots[r.shard].append(r.slot)
    assert sum(map(len, slots.values())) == len(rows)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_edges(spark):
    out = sharding.shard(clashing(edge_table(spark))).collect()
    assert len(out) == len(EDGES)
    assert sorted(r["size"] for r in out) == sorted(len((t or "").encode()) + 1 for _, t, *_ in EDGES)
    assert sharding.shard(edge_table(spark).limit(0)).count() == 0


def test_empty_tables(spark):
    none = edge_table(spark).limit(0)
    assert exact_dedup.duplicate_groups(none).count() == 0
    assert exact_dedup.drop_duplicates(none).count() == 0


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "SimHash near dedup", "mixing", "encoding"]
