"""Small inputs and plain versions the operators are compared with."""

from __future__ import annotations

import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
LONG = "wort " * 30_000 + "x" * 40_000

# nulls in every column, empty, blank and very long texts, repeated rows and ids
EDGES = [
    (1, "The cat sat on the mat. It was warm.", "en", "a", 36),
    (2, None, "en", "a", None),
    (3, "", None, None, 0),
    (4, " \t\n", "de", "b", 3),
    (5, LONG, "de", "b", len(LONG)),
    (6, "The cat  sat on the\nmat. It was warm.", "en", None, 36),
    (6, "The cat  sat on the\nmat. It was warm.", "en", None, 36),
    (None, "Ünïcode ŁETTERS İ K 日本語 \U0001f600", None, "c", 20),
    (None, None, None, None, None),
    (7, "12345 !!! 678", "fr", "c", 13),
    (8, "The cat sat on the mat. It was warm.", "en", "a", 36),
]


def edge_table(spark):
    return spark.createDataFrame(EDGES, DOCS)


def clashing(docs):
    """``docs`` with more columns, named like those the operators use inside."""
    from pyspark.sql import functions as F

    names = (
        "row_tag digest run kept keep_id key range size taken epochs shard slot unit fp component component_id node "
        "plain hits words toxicity label token c chunk score id row_epoch row_epochs held_out ids"
    ).split()
    return docs.select("*", *[F.lit(f"own {n}").alias(n) for n in names])


def closure(nodes, linked):
    """Smallest node reachable from each."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    ordered = sorted(nodes)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1:]:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def lower_ascii(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def split_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text or ""))
