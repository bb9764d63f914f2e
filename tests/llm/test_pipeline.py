"""The pipeline stage by stage against plain versions."""

import base64
import hashlib
from collections import Counter

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from earshot.llm import queries
from tests.llm.helpers import closure, edge_table, split_words
from tests.llm.test_dedup_and_mix import normal, targets
from tests.llm.test_near import plain_fingerprint
from tests.oracle import connect, difference
import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), queries.ORACLES[name]) is None


def test_all_queries_are_registered():
    names = entry_points.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {name.split("_")[0] + "_" for name in names if name.startswith("op") and name[2].isdigit()}
    assert names["pipeline"] is corpus_pipeline.run


def test_pipeline_by_brute_force(spark):
    toxic = queries.QUERIES["op3_toxicity"](spark, FOLDER)
    clean = {r.doc_id for r in toxic.where("predicted = 0").collect()}
    docs = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect() if r.doc_id in clean}
    first = {}
    for d in sorted(docs):
        first.setdefault(normal(docs[d].text), d)
    docs = {d: docs[d] for d in first.values()}
    prints = {d: plain_fingerprint(docs[d].text) for d in docs}
    group = closure(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 3)
    best = {}
    for d in sorted(docs):
        best.setdefault(group[prints[d]], d)
    docs = {d: docs[d] for d in best.values()}
    sizes, by_source = Counter(), {}
    for d, row in docs.items():
        sizes[row.source] += len(split_words(row.text))
        by_source.setdefault(row.source, []).append(d)
    wanted = Counter()
    for source, target in targets(sizes).items():
        rounds = int(target // sizes[source]) if sizes[source] else 0
        ahead = 0
        for d in sorted(by_source[source], key=lambda d: hashlib.md5(str(d).encode()).hexdigest()):
            size = len(split_words(docs[d].text))
            again = size > 0 and ahead + size / 2 <= target - rounds * sizes[source]
            ahead += size
            if rounds + again:
                wanted[d] += rounds + again
    out = entry_points.queries()["pipeline"](spark, FOLDER).collect()
    assert Counter(r.doc_id for r in out) == wanted
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(queries.VOCABULARY), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert all(list(r.ids) == library.encode_ordinary(docs[r.doc_id].text) for r in out)


def test_stages_keep_the_columns(spark):
    docs = edge_table(spark)
    extra = docs.withColumn("Kept", F.lit(1)).withColumn("row_tag", F.lit("x"))
    for number, (name, function) in enumerate(corpus_pipeline.STAGES[:-1]):
        assert function(spark, docs, FOLDER).columns == docs.columns, name
        assert function(spark, docs.limit(0), FOLDER).count() == 0
        assert function(spark, extra, FOLDER).count() >= 1
    assert corpus_pipeline.encode(spark, extra, FOLDER).count() == extra.count()
