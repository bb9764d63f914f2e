"""The filter audit, document by document and order by order."""

import re
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from earshot.llm import filter_audit
from tests.llm.helpers import DOCS, EDGES, clashing

FOLDER = "/root/testdata/sf0.001"


def plain_fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words)}
    fails["C"] = 100 * len(re.findall("[A-Z]", text)) > 2 * len(text)
    fails["D"] = re.search(r"[#$%&*|]", text) is not None
    return {k for k, failed in fails.items() if failed}


def plain_audit(rows, labels):
    """Every document through every order, one by one."""
    counts, shapley, parts = Counter(), Counter(), {part or "" for _, _, part in rows}
    ids = {}
    for d, text, _ in rows:
        ids.setdefault(text or "", []).append(float("inf") if d is None else d)
    for d, text, part in rows:
        own = plain_fails(text or "")
        if (float("inf") if d is None else d) > min(ids[text or ""]):
            own.add("E")
        good, toxic = labels.get(d, (False, False))
        for order in permutations("ABCDE"):
            gone = False
            for step, k in enumerate(order, 1):
                at = (part or "", "".join(order), step)
                if own == {k}:
                    counts[at, "unique_fails"] += 1
                if k in own and gone:
                    counts[at, "redundant"] += 1
                elif k in own:
                    gone = True
                    counts[at, "removed"] += 1
                    counts[at, "good_lost"] += good
                    counts[at, "toxic_lost"] += toxic
                    shapley[part or "", k] += 1
                counts[at, "kept"] += not gone
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
    return {
        (part, "".join(order), step, *(counts[(part, "".join(order), step), n] for n in names), shapley[part, order[step - 1]])
        for part in parts for order in permutations("ABCDE") for step in range(1, 6)
    }


def test_audit_by_brute_force(spark):
    long = [(50 + i, " ".join(f"w{j % (120 + 40 * i)}" for j in range(260)) + "|" * (i % 2), None, "b", 0) for i in range(4)]
    docs = spark.createDataFrame([*EDGES, *long, *long[:2]], DOCS)
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 1), (3, 1, 1), (8, None, 1), (50, 1, None), (51, 0, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int"
    )
    known = {1: (True, True), 3: (True, True), 8: (False, True), 50: (True, False), 51: (False, True)}
    out = filter_audit.audit(clashing(docs), clashing(labels)).collect()
    wanted = plain_audit([(r[0], r[1], r[3]) for r in docs.collect()], known)
    assert {tuple(r) for r in out} == wanted and len(out) == len(wanted)
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    assert filter_audit.audit(docs, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_counts_of_one_pass():
    """Spans of all lengths around the eight-byte lanes, words that differ in one byte only, and very many at once."""
    words = [b"x" * n + c for n in (0, 1, 6, 7, 8, 9, 15, 16, 23, 62, 63, 64, 65, 200) for c in (b"a", b"b", "é".encode())]
    words += [c + b"y" * n for n in (7, 8, 30, 63, 70) for c in (b"a", b"b")]
    texts = [b" ".join(words * 2), b"", b"\t \n", b" a\x0bA\x0cA ", "É\u00a0日本 \U0001f600#|".encode(), b"z" * 100_000]
    texts += [b" ".join(str(i % 700).encode() for i in range(5000))] * 3
    found = filter_audit.count_marks(texts)
    for i, text in enumerate(texts):
        split, points = re.findall(rb"[^\x20\x09-\x0D]+", text), text.decode()
        plain = (len(split), len(set(split)), len(re.findall("[A-Z]", points)), len(points), len(re.findall(r"[#$%&*|]", points)))
        assert tuple(int(found[k][i]) for k in ("words", "distinct", "capitals", "points", "symbols")) == plain
    assert all(len(v) == 0 for v in filter_audit.count_marks([]).values())


def test_marks_carry_the_counts(spark):
    out = filter_audit.filter_marks(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect()
    assert len(out) == 200 and all(r.distinct <= r.words <= r.points for r in out)
