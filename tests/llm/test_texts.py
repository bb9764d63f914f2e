import base64
import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from earshot.llm import bpe, context_mixing, language, licenses, queries, toxicity
from earshot.llm.common import fold_of
from tests.llm.helpers import DOCS, EDGES, clashing, edge_table, lower_ascii, split_words

FOLDER = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path(queries.VOCABULARY)


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_library(spark, encoding):
    odd = ["<|endoftext|> it's  \n\n x", "a" * 700, "ab" * 900 + "日本語" * 200, "  x 1234567 !!??\r\n", "é" * 301, "\x00\x01"]
    rows = [(d, t, None, None, None) for d, t, *_ in EDGES] + [(100 + i, t, None, None, None) for i, t in enumerate(odd)]
    docs = spark.createDataFrame(rows, DOCS).union(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    texts = Counter((r.doc_id, r.text or "") for r in docs.collect())
    wanted = Counter()
    for (doc_id, text), n in texts.items():
        ids = encoding.encode_ordinary(text)
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        wanted[doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), tuple(ids)] += n
    out = bpe.encode(clashing(docs), VOCABULARY, public_tokenizers.PATTERN).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids)) for r in out) == wanted
    assert bpe.encode(docs.limit(0), VOCABULARY, public_tokenizers.PATTERN).count() == 0


def test_base_scores_by_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").union(edge_table(spark))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fold = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 10
    counts = Counter()
    for doc_id, text in rows:
        if fold(doc_id):
            counts.update(split_words(text) + [None])
    total, distinct = sum(counts.values()), len(counts)
    wanted = []
    for doc_id, text in rows:
        tokens = split_words(text) + [None]
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens)
        wanted.append((doc_id or -1, fold(doc_id) == 0, len(tokens), sum(counts[t] > 0 for t in tokens), total, round(base, 6)))
    out = context_mixing.score(clashing(docs), bits=16).collect()
    got = [(-1 if r.doc_id is None else r.doc_id, *r[1:5], round(r.base_score, 6)) for r in out]
    wanted = [(-1 if d is None else d, *rest) for (d, _), (_, *rest) in zip(rows, wanted)]
    assert sorted(got) == sorted(wanted)
    assert all(0 < r.bits_per_byte < 8 for r in out if r.n_tokens > 50)


def test_model_beats_word_counts_on_held_out_texts(spark):
    """Although the counts give every unknown word the same price, whatever its spelling."""
    out = context_mixing.score(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))
    held = out.where("held_out").agg(F.sum("score"), F.sum("base_score"), F.avg("bits_per_byte")).first()
    assert held[0] > held[1] and held[2] < 3


def test_model_is_a_distribution(spark):
    """All tokens of up to two letters and all longer beginnings share a probability of one."""
    import pyarrow as pa

    docs = spark.createDataFrame([(i, "ab ba a b abab", None, None, None) for i in range(40)], DOCS)
    model = context_mixing.train(context_mixing.token_counts(docs, F.lit(True), "text").repartition(2), bits=12)
    every = [bytes([i]) for i in range(256) if i != 0x20]
    cost = model.cost(pa.array([b"", *every], pa.binary()))
    assert 0.0 < sum(2.0**-c for c in cost) <= 1.0
    known = model.cost(pa.array([b"ab", b"abab", b"zz"], pa.binary()))
    assert known[0] < known[2] and known[1] < known[2]


def test_model_without_rows_or_training(spark):
    assert context_mixing.score(edge_table(spark).limit(0), bits=12).count() == 0
    none = spark.createDataFrame([(None, "never learned", None, None, None)], DOCS)
    row = context_mixing.score(none, bits=12).first()
    assert row.held_out and (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)


def brute_licenses(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text or ""))
    places, base = [], set()
    for label, phrase in licenses.PHRASES.items():
        own = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(own)] == own:
                places.append(i)
                base.add(label)
    labels, best = set(base), 1.0 if places else 0.0
    for template in licenses.TEMPLATES:
        own = set(template.words)
        for start in range(max(len(words) - template.span, 0) + 1):
            run = set(words[start:start + template.span])
            if set(template.naming.split()) - run or set(template.other.split()) & run:
                continue
            if len(run & own) >= len(own) * licenses.CONTAINMENT:
                labels.add(template.label)
                best = max(best, len(run & own) / len(own))
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), best)


def test_licenses_by_brute_force(spark):
    texts = [
        "Released under the MIT License.", "x " * 70 + "apache license, MIT-LICENSE; General\nPublic License",
        "mit license mit license apache license", "permit license", "mit licenses",
        "a b c " * 20 + licenses.TEMPLATES[1].text + " d e f" * 30, " ".join(licenses.TEMPLATES[5].text.split()[2:]),
        "w " * 60 + "all rights reserved " + "w " * 60, "Kelvin K mit LİCENSE", "licensed under cc by nc 4.0",
    ]
    rows = [(d, t, None, None, None) for d, t, *_ in EDGES] + [(50 + i, t, None, None, None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS).union(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    wanted = Counter((r.doc_id, *brute_licenses(r.text)) for r in docs.collect())
    out = licenses.license_labels(clashing(docs)).drop("row_tag").collect()
    assert Counter(tuple(r) for r in out) == wanted
    assert any(r.labels != r.base_labels for r in out)
    assert licenses.license_labels(docs.limit(0)).count() == 0


def test_a_notice_of_another_license_gets_its_own_label(spark):
    wanted = {
        "Released under the Apache License": "apache", "released under the BSD license": "",
        "Licensed under CC BY 4.0": "", "licensed under CC BY-NC 4.0": "cc-by-nc", "licensed under CC BY-NC-SA 4.0": "",
        "some software license, version 2.0, was licensed under the old rules": "",
        "Licensed under the Apache License, Version 2.0 (the License)": "apache",
        "reserved seats for all; human rights": "", "(c) someone. All rights reserved.": "reserved",
        "Distributed and released under the MIT license.": "mit",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.": "cc-by",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": "",
    }
    docs = spark.createDataFrame(list(enumerate(wanted)), "doc_id bigint, text string")
    found = {r.doc_id: r.labels for r in licenses.license_labels(docs).collect()}
    assert {text: found[i] for i, text in enumerate(wanted)} == wanted


def test_a_long_template_is_found_across_blocks(spark):
    whole = [f"w{i}" for i in range(160)]
    cut = [w for i, w in enumerate(whole) if i % 5]  # 128 of 160 words, in a run of 160 with others between
    filled = [w if i % 5 else f"x{i}" for i, w in enumerate(whole)]
    texts = {
        1: " ".join(["a"] * 333 + whole + ["b"] * 50), 2: " ".join(["a"] * 97 + filled), 3: " ".join(cut),
        4: " ".join(filled[:-1]), 5: " ".join(whole[:80] + ["y"] * 100 + whole[80:]),
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    out = {r.doc_id: (r.labels, r.score) for r in licenses.license_labels(docs, templates=[("long", " ".join(whole))]).collect()}
    assert out == {1: ("long", 1.0), 2: ("long", 0.8), 3: ("long", 0.8), 4: ("", 0.0), 5: ("", 0.0)}


def test_needed_words_are_exact():
    assert licenses.needed(5, Fraction(4, 5)) == 4 and licenses.needed(6, Fraction(4, 5)) == 5


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    rows = entry_points.queries()["op3_toxicity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    held = rows.where("held_out").select("predicted", "toxic").toPandas()
    hits = ((held.predicted == 1) & (held.toxic == 1)).sum()
    assert hits >= 0.8 * (held.toxic == 1).sum()
    assert ((held.predicted == 1) & (held.toxic == 0)).sum() <= 0.01 * (held.toxic == 0).sum()


def test_toxic_sentences_are_found(spark):
    clean = ["we walk in the park", "rain falls on the town", "she reads a long book", "the old tree stands"]
    rows, labels = [], []
    for i in range(200):
        toxic = i % 4 == 0
        rows.append((i, ". ".join(clean[(i + k) % 4] for k in range(3)) + (". You vilewort. " if toxic else ". ") + clean[i % 4], None, None, None))
        labels.append((i, int(toxic)))
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.train(docs, known, fold_of(F.col("doc_id"), 3) != 1)
    scored = {r.doc_id: r.toxicity for r in toxicity.score(docs, model).collect()}
    assert all((scored[i] >= 0.7) == bool(toxic) for i, toxic in labels)
    found = toxicity.offending_sentences(docs, model).collect()
    assert {(r.doc_id, r.sentence) for r in found} == {(i, 3) for i, toxic in labels if toxic}
    assert toxicity.reject_toxic(clashing(docs), model).count() == 150
    upper = docs.withColumn("Toxicity", F.lit("own"))
    assert toxicity.reject_toxic(upper, model).columns == upper.columns
    assert toxicity.reject_toxic(upper, model).count() == 150
    assert toxicity.score(upper, model).columns == [*upper.columns, "toxicity_"]


def test_toxicity_of_edges(spark):
    docs = edge_table(spark)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.train(docs, none, F.lit(True))
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(EDGES) and all(0 <= r.toxicity < 0.7 for r in out)
    assert toxicity.score(docs.limit(0), model).count() == 0
    odd = spark.createDataFrame([(1, None), (None, 1), (3, 2), (4, 1), (4, 0)], "doc_id bigint, toxic int")
    assert toxicity.score(docs, toxicity.train(docs, odd, F.lit(True))).count() == len(EDGES)


def test_languages_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    found = entry_points.queries()["op8_byte_network"](spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id")
    held = found.where("held_out").toPandas()
    assert (held.lang_pred == held.lang).mean() >= 0.95
    assert held.score.between(0, 1).all()


def test_languages_of_edges(spark):
    docs = edge_table(spark)
    network = language.train(docs, F.lit(True))
    out = language.predict(clashing(docs), network).collect()
    texts = {}
    for d, t, *_ in EDGES:
        texts.setdefault(d, []).append(t or "")
    assert len(out) == len(EDGES)
    for r in out:
        if not any(any(map(str.isalpha, t)) for t in texts[r.doc_id]):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert 0 <= r.score <= 1
    assert language.train(docs.limit(0), F.lit(True)) is None
    assert {r.lang_pred for r in language.predict(docs, None).collect()} == {"und"}


def test_rows_are_scored_alone(spark):
    """A text has the same score whatever stands beside it."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    network = language.train(docs, F.lit(True), sample=50, epochs=2)
    together = {r.doc_id: r.score for r in language.predict(docs, network).collect()}
    alone = {r.doc_id: r.score for r in language.predict(docs.where("doc_id < 5").repartition(5), network).collect()}
    assert all(abs(together[d] - s) < 1e-6 for d, s in alone.items())
