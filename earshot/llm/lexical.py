"""Ranked lexical search over posting lists blocked by document similarity.

Documents are laid out by the pivots they are most like. The posting list of
each term a query needs is cut into small blocks of documents that are near in
that order and alike in the terms that count beside it; every block stores the
largest contribution of each of those terms. The summary of a block times the
weights of a query is a bound of the score of all its documents: a block whose
bound is below the tenth best score known is skipped, the documents of all
others are scored in full. No document that belongs among the best is lost.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.llm.common import TAG, numbered, slices
from earshot.session import ship_with_jobs, stage

BEST = 10
# documents in a block, at most
BLOCK = 8
# queries worked on together, and the bytes of their texts
QUERIES = 512
QUERY_BYTES = 4 << 20
# pivots and the sampled documents their weights come from; only the order of documents depends on them
PIVOTS = 32
SAMPLE = 512
# the rarest terms of a query and about how many documents of each give a first tenth best score
SEED_TERMS = 16
SEED_DOCS = 512
# bytes of a dense piece of documents times terms in a worker
DENSE_BYTES = 96 << 20
# summaries are kept in units of this many points, rounded up
_UNIT = 8

_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def split_terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all other code points from U+0080 on, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split(b" ")


@dataclass
class Asked:
    """A set of queries as plain arrays: codes of terms, and for query i the span ``starts[i]:starts[i + 1]``."""

    terms: list[bytes]
    starts: np.ndarray
    codes: np.ndarray
    times: np.ndarray

    def of(self, query: int) -> tuple[np.ndarray, np.ndarray]:
        span = slice(self.starts[query], self.starts[query + 1])
        return self.codes[span], self.times[span]


def ask(texts: list[str | None]) -> Asked:
    counted = [Counter(filter(None, split_terms(text))) for text in texts]
    terms = sorted(set().union(*counted)) if counted else []
    code = {term: i for i, term in enumerate(terms)}
    pairs = [sorted((code[t], n) for t, n in c.items()) for c in counted]
    flat = np.array([p for own in pairs for p in own], dtype=np.int64).reshape(-1, 2)
    return Asked(terms, np.cumsum([0, *map(len, pairs)]), flat[:, 0].copy(), flat[:, 1].copy())


def count_terms(texts: pa.Array, terms: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Number of terms of every text, and row, code and occurrences of those among ``terms``, by row and code."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + n + 1]
    data = texts.buffers()[2]
    data = data.slice(offsets[0], offsets[-1] - offsets[0]).to_pybytes() if data is not None else b""
    clean = pa.Array.from_buffers(
        pa.string(), n, [None, pa.py_buffer((offsets - offsets[0]).astype(np.int32)), pa.py_buffer(data.translate(_TERM_BYTES))]
    )
    lists = pc.ascii_split_whitespace(clean)
    words = lists.flatten()
    owner = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
    full = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    sizes = np.bincount(owner[full], minlength=n)
    codes = pc.fill_null(pc.index_in(words.cast(pa.binary()), value_set=terms), -1).to_numpy(zero_copy_only=False)
    known = codes >= 0
    width = max(1, len(terms))
    keys, times = np.unique(owner[known] * width + codes[known], return_counts=True)
    return sizes, keys // width, keys % width, times


def _lists(values: np.ndarray, rows: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(n + 1, dtype=np.int32)
    np.cumsum(np.bincount(rows, minlength=n), out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))


def fit_pivots(docs: DataFrame, text_column: str, terms: pa.Array) -> np.ndarray:
    """Directions (terms times pivots) of sampled documents, with weights that are larger for rarer terms."""
    n = docs.count()
    sampled = docs.select(F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    sampled = sampled.sample(min(1.0, SAMPLE / max(n, 1)), seed=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                _, rows, codes, times = count_terms(piece.column("text"), terms)
                columns = [_lists(codes, rows, piece.num_rows, pa.int32()), _lists(times, rows, piece.num_rows, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["codes", "times"])

    found = [r for r in sampled.mapInArrow(run, "codes array<int>, times array<int>").collect() if r.codes]
    weights = np.zeros((len(terms), PIVOTS), dtype=np.float32)
    df = np.zeros(len(terms))
    for r in found:
        df[r.codes] += 1
    rarity = np.log((len(found) + 1) / (df + 0.5)).clip(0)
    for i, r in enumerate(found[:PIVOTS]):
        weights[r.codes, i] = np.log1p(r.times) * rarity[r.codes]
    return rarity[:, None].astype(np.float32) * weights / np.maximum(np.linalg.norm(weights, axis=0), 1e-9)


def vectors(docs: DataFrame, asked: Asked, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every document's number of terms, its ``place`` among documents like it, and the asked terms it holds."""
    terms = pa.array(asked.terms, pa.binary())
    rows = numbered(docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    ))
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((asked.terms, fit_pivots(docs, text_column, terms)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, pivots = shared.value
        terms = pa.array(names, pa.binary())
        for batch in batches:
            for piece in slices(batch):
                n = piece.num_rows
                sizes, rows, codes, times = count_terms(piece.column("text"), terms)
                likeness = np.zeros((n, PIVOTS), dtype=np.float32)
                if len(rows):
                    firsts = np.flatnonzero(np.diff(rows, prepend=-1))
                    likeness[rows[firsts]] = np.add.reduceat(pivots[codes] * np.log1p(times)[:, None].astype(np.float32), firsts)
                near = np.argsort(-likeness, axis=1, kind="stable")[:, :3]
                place = (near[:, 0] * PIVOTS + near[:, 1]) * PIVOTS + near[:, 2]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(TAG), piece.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(place, pa.int64()),
                     _lists(codes, rows, n, pa.int32()), _lists(times, rows, n, pa.int32())],
                    names=[TAG, "doc_id", "size", "place", "codes", "times"],
                )

    return rows.mapInArrow(run, f"{TAG} bigint, doc_id {kind}, size bigint, place bigint, codes array<int>, times array<int>")


@dataclass
class Corpus:
    """What the formula needs of all documents: their number, their terms, and the weight of every asked term."""

    n: int
    terms: int
    df: np.ndarray
    weights: np.ndarray


def measure(vecs: DataFrame, asked: Asked) -> Corpus:
    total = vecs.where("size > 0").agg(F.count("*").alias("n"), F.sum("size").alias("terms")).first()
    df = np.zeros(len(asked.terms), dtype=np.int64)
    for row in vecs.select(F.explode("codes").alias("code")).groupBy("code").count().collect():
        df[row["code"]] = row["count"]
    weights = [math.floor(1000 * math.log((2 * total.n + 2) / (2 * int(d) + 1))) for d in df]
    return Corpus(total.n, total.terms or 0, df, np.array(weights, dtype=np.int64))


def postings(batch: pa.RecordBatch, corpus: Corpus) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, code and contribution of every asked term of every document of the batch."""
    codes, times = batch.column("codes"), batch.column("times")
    rows = np.repeat(np.arange(batch.num_rows), np.diff(codes.offsets.to_numpy()))
    code, tf = codes.flatten().to_numpy().astype(np.int64), times.flatten().to_numpy().astype(np.int64)
    m = 25 + 75 * batch.column("size").to_numpy() * corpus.n // max(corpus.terms, 1)
    return rows, code, corpus.weights[code] * (1_000_000_000 * tf // (1000 * tf + 8 * m[rows]))


def dense_pieces(batch: pa.RecordBatch, corpus: Corpus, item_bytes: int = 8):
    """Bounded pieces of the batch with their postings: first row, rows, row, code, points."""
    rows, codes, points = postings(batch, corpus)
    step = max(1, DENSE_BYTES // (item_bytes * max(1, len(corpus.weights))))
    for first in range(0, batch.num_rows, step):
        lo, hi = np.searchsorted(rows, [first, first + step])
        yield first, min(step, batch.num_rows - first), rows[lo:hi] - first, codes[lo:hi], points[lo:hi]


def first_bests(vecs: DataFrame, asked: Asked, corpus: Corpus, best: int = BEST) -> tuple[np.ndarray, np.ndarray]:
    """A score that ``best`` documents reach, for every query, and the largest contribution of every term.

    Scores of any documents will do: here those of a bounded number that hold
    one of the rarest terms of the query. 0 where fewer documents are found.
    """
    n_queries = len(asked.starts) - 1
    by_term: dict[int, list[int]] = {}
    for query in range(n_queries):
        own, _ = asked.of(query)
        own = own[corpus.df[own] > 0]
        for code in own[np.argsort(corpus.df[own], kind="stable")][:SEED_TERMS].tolist():
            by_term.setdefault(code, []).append(query)
    one_of = np.maximum(1, corpus.df // SEED_DOCS)
    seeds = np.zeros(len(asked.terms), dtype=bool)
    seeds[list(by_term)] = True
    shared = vecs.sparkSession.sparkContext.broadcast(
        (asked.terms, asked.starts, asked.codes, asked.times, vars(corpus), by_term, seeds, one_of)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *parts, figures, by_term, seeds, one_of = shared.value
        asked, corpus = Asked(*parts), Corpus(**figures)
        largest = np.zeros(len(asked.terms), dtype=np.int64)
        for batch in batches:
            tags = batch.column(TAG).to_numpy()
            mixed = (tags.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            scores: list[tuple[int, np.ndarray]] = []
            for first, n, rows, codes, points in dense_pieces(batch, corpus):
                np.maximum.at(largest, codes, points)
                drawn = seeds[codes] & (mixed[first + rows] % one_of[codes] == 0)
                met: dict[int, list[int]] = {}
                for row, code in zip(rows[drawn].tolist(), codes[drawn].tolist()):
                    for query in by_term[code]:
                        met.setdefault(query, []).append(row)
                if met:
                    dense = np.zeros((n, len(asked.terms)), dtype=np.int64)
                    dense[rows, codes] = points
                for query, own in met.items():
                    terms, times = asked.of(query)
                    scores.append((query, dense[np.ix_(np.unique(own), terms)] @ times))
            if scores:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([q for q, _ in scores], [len(s) for _, s in scores]).astype(np.int32)),
                     pa.array(np.concatenate([s for _, s in scores]))], names=["key", "value"],
                )
        held = np.flatnonzero(largest)
        yield pa.RecordBatch.from_arrays([pa.array((-1 - held).astype(np.int32)), pa.array(largest[held])], names=["key", "value"])

    found = stage(vecs.mapInArrow(run, "key int, value bigint"), "search-seeds")
    largest = np.zeros(len(asked.terms), dtype=np.int64)
    for row in found.where("key < 0").groupBy("key").agg(F.max("value").alias("value")).collect():
        largest[-1 - row.key] = row.value
    down = Window.partitionBy("key").orderBy(F.desc("value"))
    known = np.zeros(n_queries, dtype=np.int64)
    last = found.where("key >= 0").withColumn("rank", F.row_number().over(down)).where(F.col("rank") <= best)
    for row in last.where(F.col("rank") == best).collect():
        known[row.key] = row.value
    return known, largest


def needed_lists(asked: Asked, known: np.ndarray, largest: np.ndarray, df: np.ndarray) -> dict[int, tuple]:
    """For every term whose list a query must read: the queries, the terms beside it, and two things by query.

    These are the weights of the terms beside it, and which of them are rarer
    lists that the same query reads. All terms of a query that are not needed
    stay together below its known score, so a document without a needed term
    cannot be among its best.
    """
    readers: dict[int, list[tuple[int, np.ndarray]]] = {}
    for query, least in enumerate(known.tolist()):
        codes, times = asked.of(query)
        most = largest[codes] * times
        order = np.argsort(most, kind="stable")
        lists = codes[order[np.cumsum(most[order]) >= max(least, 1)]]
        lists = lists[np.argsort(df[lists], kind="stable")]
        for place, code in enumerate(lists.tolist()):
            readers.setdefault(code, []).append((query, lists[:place]))
    found = {}
    for code, reading in readers.items():
        beside = np.unique(np.concatenate([asked.of(q)[0] for q, _ in reading]))
        weights = np.zeros((len(beside), len(reading)), dtype=np.int64)
        for column, (q, _) in enumerate(reading):
            own, times = asked.of(q)
            weights[np.searchsorted(beside, own), column] = times
        found[code] = ([q for q, _ in reading], beside, weights, [np.searchsorted(beside, rarer) for _, rarer in reading])
    return found


def blocks(vecs: DataFrame, corpus: Corpus, needed: dict, block: int = BLOCK) -> DataFrame:
    """The index: ``term``, the ``tags`` of a block of its list, and ``most``, the summary over the terms beside it.

    Documents are sorted by place and worked on in bounded pieces of that
    order; a place that very many documents share is cut by their tags. Within
    a piece, the documents of a list go together that point the same way in the
    space of the terms beside it, by their largest component, and lie about
    equally far out. A list leaves out a document that each of its queries
    meets in the list of a rarer term.
    """
    beside = {code: (own, rarer) for code, (_, own, _, rarer) in needed.items()}
    shared = vecs.sparkSession.sparkContext.broadcast((vars(corpus), beside))
    names = [TAG, "size", "place", "codes", "times"]
    ordered = vecs.select(*names).where(F.size("codes") > 0).repartitionByRange("place", TAG).sortWithinPartitions("place", TAG)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        figures, beside = shared.value
        corpus = Corpus(**figures)
        wanted = np.zeros(len(corpus.weights), dtype=bool)
        wanted[list(beside)] = True
        for batch in batches:
            tags = batch.column(TAG).to_numpy()
            for first, n, rows, codes, points in dense_pieces(batch, corpus, 4):
                dense = np.zeros((n, len(corpus.weights)), dtype=np.uint32)
                dense[rows, codes] = (points + (_UNIT - 1)) // _UNIT
                listed = np.flatnonzero(wanted[codes])
                listed = listed[np.argsort(codes[listed], kind="stable")]
                if not len(listed):
                    continue
                cuts = np.flatnonzero(np.diff(codes[listed], prepend=-1, append=-1))
                terms, sizes, most, members = [], [], [], []
                for lo, hi in zip(cuts, cuts[1:]):
                    term = int(codes[listed[lo]])
                    own = rows[listed[lo:hi]]
                    others, rarer = beside[term]
                    seen = dense[np.ix_(own, others)]
                    met = np.all([(seen[:, columns] > 0).any(axis=1) for columns in rarer], axis=0)
                    own, seen = own[~met], seen[~met]
                    if not len(own):
                        continue
                    others_only = seen.copy()
                    others_only[:, np.searchsorted(others, term)] = 0
                    order = np.lexsort((others_only.sum(axis=1, dtype=np.int64), others_only.argmax(axis=1)))
                    starts = np.arange(0, len(own), block)
                    members.append(own[order])
                    most.append(np.maximum.reduceat(seen[order], starts, axis=0))
                    terms.append(np.full(len(starts), term, dtype=np.int32))
                    sizes.append(np.diff(np.append(starts, len(own))))
                if not most:
                    continue
                widths = np.repeat([m.shape[1] for m in most], [m.shape[0] for m in most])
                ends = np.append(0, np.cumsum(np.concatenate(sizes))).astype(np.int32)
                wide = np.append(0, np.cumsum(widths)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(terms)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(tags[first + np.concatenate(members)])),
                     pa.ListArray.from_arrays(pa.array(wide), pa.array(np.concatenate([m.ravel() for m in most]).astype(np.int64)))],
                    names=["term", "tags", "most"],
                )

    return ordered.mapInArrow(run, "term int, tags array<bigint>, most array<bigint>")


def open_blocks(index: DataFrame, known: np.ndarray, needed: dict) -> DataFrame:
    """``query`` and ``row_tag`` of the documents in blocks whose bound reaches the query's known score."""
    shared = index.sparkSession.sparkContext.broadcast((known, needed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, needed = shared.value
        for batch in batches:
            terms, tags, most = batch.column("term").to_numpy(), batch.column("tags"), batch.column("most")
            ends, wide = tags.offsets.to_numpy(), most.offsets.to_numpy()
            tag, points = tags.values.to_numpy(), most.values.to_numpy()
            found_queries, found_tags = [], []
            cuts = np.flatnonzero(np.diff(terms, prepend=-1, append=-1))
            for lo, hi in zip(cuts, cuts[1:]):
                queries, _, weights, _ = needed[int(terms[lo])]
                bounds = _UNIT * (points[wide[lo]:wide[hi]].reshape(hi - lo, -1) @ weights)
                at, column = np.nonzero(bounds >= np.maximum(known[queries], 1))
                sizes = ends[lo + at + 1] - ends[lo + at]
                place = np.arange(sizes.sum()) + np.repeat(ends[lo + at] - (np.cumsum(sizes) - sizes), sizes)
                found_queries.append(np.repeat(np.array(queries, dtype=np.int32)[column], sizes))
                found_tags.append(tag[place])
            if found_tags and sum(map(len, found_tags)):
                pairs = np.unique(np.stack([np.concatenate(found_tags), np.concatenate(found_queries)]), axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[1].astype(np.int32)), pa.array(pairs[0])], names=["query", TAG]
                )

    return index.mapInArrow(run, f"query int, {TAG} bigint")


def full_scores(vecs: DataFrame, opened: DataFrame, asked: Asked, corpus: Corpus) -> DataFrame:
    """``query``, ``row_tag``, ``doc_id`` and ``score`` of every pair opened."""
    shared = vecs.sparkSession.sparkContext.broadcast((asked.terms, asked.starts, asked.codes, asked.times, vars(corpus)))
    # a document has at most as many queries as are worked on together
    gathered = opened.groupBy(TAG).agg(F.collect_set("query").alias("queries"))
    rows = vecs.drop("place").join(gathered, TAG)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *parts, figures = shared.value
        asked, corpus = Asked(*parts), Corpus(**figures)
        for batch in batches:
            queries = batch.column("queries")
            owner = np.repeat(np.arange(batch.num_rows), np.diff(queries.offsets.to_numpy()))
            query = queries.flatten().to_numpy()
            for first, n, rows, codes, points in dense_pieces(batch, corpus):
                dense = np.zeros((n, len(asked.terms)), dtype=np.int64)
                dense[rows, codes] = points
                lo, hi = np.searchsorted(owner, [first, first + n])
                order = lo + np.argsort(query[lo:hi], kind="stable")
                cuts = np.flatnonzero(np.diff(query[order], prepend=-1, append=-1))
                scores = np.zeros(len(order), dtype=np.int64)
                for start, end in zip(cuts, cuts[1:]):
                    terms, times = asked.of(int(query[order[start]]))
                    scores[start:end] = dense[np.ix_(owner[order[start:end]] - first, terms)] @ times
                at = pa.array(owner[order])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query[order].astype(np.int32)), batch.column(TAG).take(at), batch.column("doc_id").take(at),
                     pa.array(scores)], names=["query", TAG, "doc_id", "score"],
                )

    return rows.mapInArrow(run, f"query int, {TAG} bigint, doc_id {kind}, score bigint")


def search_together(
    docs: DataFrame, texts: list[str | None], id_column: str = "doc_id", text_column: str = "text", best: int = BEST,
    block: int = BLOCK,
) -> DataFrame:
    """``query`` (place in ``texts``), ``rank``, ``doc_id``, ``score`` and ``row_tag`` for a bounded number of queries."""
    asked = ask(texts)
    vecs = stage(vectors(docs, asked, id_column, text_column), "search-vectors")
    corpus = measure(vecs, asked)
    known, largest = first_bests(vecs, asked, corpus, best)
    needed = needed_lists(asked, known, largest, corpus.df)
    index = stage(blocks(vecs, corpus, needed, block), "search-blocks")
    opened = stage(open_blocks(index, known, needed), "search-opened")
    down = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), TAG)
    scored = full_scores(vecs, opened, asked, corpus).where("score > 0")
    return scored.withColumn("rank", F.row_number().over(down)).where(F.col("rank") <= best)


def search(
    docs: DataFrame, queries: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    query_id: str = "item_id", query_text: str = "text", best: int = BEST, block: int = BLOCK,
) -> DataFrame:
    """The ``best`` documents of every query: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score``.

    Only documents with a score above 0 are ranked; equal scores go by id,
    null ids last, and by row. Queries are read in blocks of bounded size, and
    each block's documents and index are stored tables. Null and empty
    documents count for nothing, null and empty queries find nothing; very
    long texts are read whole; repeated documents are ranked one beside the
    other, repeated queries are answered each; further columns are not looked
    at, whatever their names. Empty tables on either side give no rows.
    """
    asked_for = queries.select(F.col(query_id).alias("item_id"), F.col(query_text).cast("string").alias("text"))
    spark = docs.sparkSession
    answers, ids, texts, size = [], [], [], 0
    kind = asked_for.schema["item_id"]

    def answer() -> None:
        found = search_together(docs, texts, id_column, text_column, best, block)
        names = spark.createDataFrame(list(enumerate(ids)), f"query int, item_id {kind.dataType.simpleString()}")
        found = found.join(F.broadcast(names), "query")
        answers.append(stage(found.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "search-answers"))

    for row in asked_for.toLocalIterator():
        ids.append(row.item_id)
        texts.append(row.text)
        size += len(row.text or "")
        if len(ids) == QUERIES or size >= QUERY_BYTES:
            answer()
            ids, texts, size = [], [], 0
    if ids or not answers:
        answer()
    return reduce(DataFrame.union, answers)


ship_with_jobs(__name__)
