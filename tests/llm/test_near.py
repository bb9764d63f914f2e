import random

import numpy as np
import xxhash

from earshot.llm import embeddings, simhash
from earshot.llm.components import connected_components, over_groups
from tests.llm.helpers import DOCS, EDGES, clashing, closure, edge_table, split_words


def plain_fingerprint(text):
    words = split_words(text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_spark_has_the_same_hash(spark):
    from pyspark.sql import functions as F

    for word in ("abc", "é x y", "w" * 100):
        own = spark.range(1).select(F.xxhash64(F.lit(word))).first()[0]
        assert own % 2**64 == xxhash.xxh64_intdigest(word.encode(), 42)


def test_edges_by_brute_force(spark):
    for table in (edge_table(spark), clashing(edge_table(spark))):
        rows = simhash.near_duplicates(table).collect()
        assert sorted(r.fp % 2**64 for r in rows) == sorted(plain_fingerprint(t) for _, t, *_ in EDGES)
        prints = {r.fp % 2**64 for r in rows}
        group = closure(prints, lambda a, b: (a ^ b).bit_count() <= 3)
        for r in rows:
            ids = [x.doc_id for x in rows if group[x.fp % 2**64] == group[r.fp % 2**64] and x.doc_id is not None]
            assert r.component_id == (min(ids) if ids else None)
        assert sum(r.kept for r in rows) == len(set(group.values()))


def test_links_by_brute_force(spark):
    dice = random.Random(3)
    prints = {dice.getrandbits(64) for _ in range(300)}
    for centre in list(prints)[:20]:
        for _ in range(60):
            prints.add(centre ^ sum({1 << dice.randrange(64) for _ in range(dice.randrange(1, 6))}))
    # a tight ball, so that values are met by long runs and split into blocks
    prints |= {dice.choice([0, 5]) ^ sum({1 << dice.randrange(24) for _ in range(3)}) for _ in range(800)}
    signed = [(int(np.uint64(p).view(np.int64)),) for p in prints]
    for cap in (50, 4096):
        links = simhash.near_links(spark.createDataFrame(signed, "fp bigint"), cap=cap)
        found = {r.node: r.component for r in connected_components(links).collect()}
        group = closure({s for s, in signed}, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3)
        assert {s: found.get(s, s) for s, in signed} == group


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, i) for i in range(1001, 1200)] + [(7, 7)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(101)}, **{i: 1000 for i in range(1000, 1200)}}


def test_no_rows(spark):
    assert simhash.near_duplicates(edge_table(spark).limit(0)).count() == 0
    assert simhash.drop_near_duplicates(edge_table(spark).limit(0)).count() == 0


def test_groups_reach_over_batches(spark):
    import pyarrow as pa

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = spark.createDataFrame([(i % 5, i) for i in range(200)], "k bigint, v bigint").coalesce(1)

        def count(table, starts):
            return pa.RecordBatch.from_arrays(
                [table.column("k").take(pa.array(starts[:-1])).combine_chunks(), pa.array(np.diff(starts))], names=["k", "n"]
            )

        assert {tuple(r) for r in over_groups(rows, ["k"], count, "k bigint, n bigint").collect()} == {(k, 40) for k in range(5)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def vectors():
    dice = np.random.default_rng(1)
    rows = []
    centres = dice.standard_normal((40, 16))
    for i in range(1500):
        v = centres[i % 40] + dice.standard_normal(16) * (0.08 if i % 3 else 0.8)
        rows.append((i, [float(x) for x in v.astype(np.float32)], i % 3 if i % 50 else None))
    rows += [(2000 + i, rows[4][1], 1) for i in range(30)]
    rows += [(3000, None, 1), (3001, [0.0] * 16, 1), (3002, [float("nan")] * 16, 1), (3003, [None] * 16, 1),
             (3004, [float("inf")] + [1.0] * 15, 1), (3005, [], 1), (3006, [1.0, 2.0], 1), (3007, [2.0, 4.0], 1),
             (3008, [1.0, None], 1)]
    return rows


def brute_force(rows):
    ok = {}
    for i, v, label in rows:
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[i] = (np.array(v) / np.linalg.norm(v), label)
    near = lambda a, b: ok[a][1] == ok[b][1] and len(ok[a][0]) == len(ok[b][0]) and ok[a][0] @ ok[b][0] >= 0.98
    group = closure(ok, near)
    links = {a: sum(near(a, b) for b in ok if b != a) for a in ok}
    return {i: (links.get(i, 0), group.get(i, i)) for i, _, _ in rows}


def test_forest_by_brute_force(spark):
    rows = vectors()
    expected = brute_force(rows)
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    for options in ({"leaf": 64}, {"leaf": 64, "cap": 100}, {"leaf": 32, "sample": 300}):
        out = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_vectors(table, **options).collect()}
        assert len(out) == len(rows)
        wanted = sum(n for n, _ in expected.values())
        found = sum(n for n, _ in out.values())
        assert all(out[i][0] <= expected[i][0] for i in out)
        assert found >= 0.98 * wanted
        assert sum(out[i][1] == expected[i][1] for i in out) >= 0.99 * len(out)


def test_vectors_without_rows_ids_and_with_clashing_names(spark):
    from pyspark.sql import functions as F

    schema = "vec_id bigint, embedding array<float>, label int"
    assert embeddings.near_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (6, [1.0, 0.01], 1)]
    table = spark.createDataFrame(rows, schema).select("*", F.lit(1).alias("node"), F.lit(2).alias("row_tag"))
    out = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(table).collect())
    assert out == [(0, 0, None, False), (5, 2, 5, True), (5, 2, 5, True), (6, 2, 5, False)]


def test_short_text_words():
    assert split_words("A b") == ["a", "b"] and simhash.fingerprint("A b") == plain_fingerprint("a  B")
    assert DOCS.startswith("doc_id")
