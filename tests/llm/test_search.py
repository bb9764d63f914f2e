"""Ranked search against scoring every document for every query."""

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from earshot.llm import lexical
from tests.llm.helpers import DOCS, EDGES, clashing, lower_ascii

ITEMS = "item_id bigint, text string"


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower_ascii(text or ""))


def plain_ranking(rows, items, best=10):
    counts = [(d, Counter(plain_terms(t))) for d, t in rows]
    n = sum(1 for _, c in counts if c)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = Counter()
    for item, text in items:
        scored = []
        for d, c in counts:
            m = 25 + 75 * sum(c.values()) * n // max(total, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in plain_terms(text) if c[t]
            )
            if score > 0:
                scored.append((-score, d is None, d))
        for rank, (score, _, d) in enumerate(sorted(scored)[:best], 1):
            out[item, rank, d, -score] += 1
    return out


def answer(docs, queries, **options):
    return Counter(tuple(r) for r in lexical.search(docs, queries, **options).collect())


def test_search_by_brute_force(spark):
    dice = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    rows = [(100 + i, " ".join(dice.choices(words, weights=range(1, 61), k=dice.randrange(1, 40)))) for i in range(700)]
    # many copies, so that scores tie, beside the edge cases
    rows += [(2000 + i, rows[5][1]) for i in range(200)] + [(r[0], r[1]) for r in EDGES] * 2
    items = [(i, " ".join(dice.choices(words, k=dice.randrange(1, 9)))) for i in range(25)]
    items += [(50, None), (51, " .,"), (52, "The CAT, the cat. nowhere"), (52, rows[5][1]), (None, "w3 w3"), (53, "Ünïcode ŁETTERS \U0001f600")]
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCS).repartition(6)
    queries = spark.createDataFrame(items, ITEMS)
    wanted = plain_ranking(rows, items)
    assert answer(clashing(docs), clashing(queries)) == wanted
    assert answer(docs, queries, block=1) == wanted
    assert answer(docs, queries, best=3) == plain_ranking(rows, items, 3)
    assert not answer(docs.limit(0), queries) and not answer(docs, queries.limit(0))


def test_queries_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "QUERIES", 2)
    monkeypatch.setattr(lexical, "SEED_DOCS", 1)
    monkeypatch.setattr(lexical, "SEED_TERMS", 1)
    monkeypatch.setattr(lexical, "DENSE_BYTES", 64)
    rows = [(i, f"a{i % 3} b{i % 5} c{i % 7}") for i in range(60)]
    items = [(i, f"a{i} b{i} c{i} c{i}") for i in range(5)]
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCS)
    assert answer(docs, spark.createDataFrame(items, ITEMS)) == plain_ranking(rows, items)


def test_most_blocks_are_skipped(spark):
    """Bounds rule out most documents that hold a needed term, and few pairs of document and query have one."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect()]
    asked = lexical.ask(texts)
    vecs = lexical.vectors(docs, asked).cache()
    corpus = lexical.measure(vecs, asked)
    known, largest = lexical.first_bests(vecs, asked, corpus)
    needed = lexical.needed_lists(asked, known, largest, corpus.df)
    index = lexical.blocks(vecs, corpus, needed, 4).cache()
    opened = lexical.open_blocks(index, known, needed).distinct().count()
    tags = index.select("term", F.explode("tags").alias("tag"))
    readers = spark.createDataFrame([(t, q) for t, (qs, *_) in needed.items() for q in qs], "term int, query int")
    reached = tags.join(readers, "term").select("tag", "query").distinct().count()
    assert opened < reached / 3 and reached < docs.count() * len(texts) / 2
