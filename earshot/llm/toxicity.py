"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence has a logistic score over its
words, and the document is toxic if any sentence is: its probability is the
noisy-or of its sentences. Only document labels are needed to fit the words;
afterwards the sentence scores tell where the offence is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import slices
from earshot.session import ship_with_jobs

BUCKETS = 1 << 18
# labelled rows the fit takes at most, of either label
SAMPLE = 3_000
EPOCHS = 120
CUT = 0.7
# words of a stretch without sentence end that count as one sentence
LONGEST = 64
_EDGE = ".,;:!?\"'()[]{}<>*_-–—…«»„“”‘’¡¿#$%&@^~`|/\\=+"
_ENDS = (".", "!", "?", "…")


def _features(word: str) -> tuple[int, int, int]:
    """Buckets of a word and of its first four and five letters; marks around it do not count."""
    core = word.strip(_EDGE)
    return tuple(crc32(f"{kind}{part}".encode("utf-8")) % BUCKETS if core else 0
                 for kind, part in (("w", core), ("4", core[:4]), ("5", core[:5])))


def _sentences(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts as rows of a feature table, the table, first word and text of each sentence.

    Line ends close a sentence, and so do words that end with a full stop,
    exclamation or question mark. Texts without words have no sentence.
    """
    marked = pc.replace_substring(pc.ascii_lower(texts), "\n", " . ")
    lists = pc.ascii_split_whitespace(marked)
    words = lists.flatten()
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    coded = words.dictionary_encode()
    code = coded.indices.to_numpy()
    distinct = coded.dictionary.to_pylist()
    table = np.array([_features(w) for w in distinct], dtype=np.int64).reshape(-1, 3)
    real = np.array([bool(w.strip(_EDGE)) for w in distinct], dtype=bool)[code]
    ends = np.array([w.rstrip("\"')]}»“”’").endswith(_ENDS) for w in distinct], dtype=bool)[code]
    new = np.ones(len(code), dtype=bool)
    new[1:] = ends[:-1] | (owner[1:] != owner[:-1])
    sentence = np.cumsum(new) - 1
    code, owner, sentence = code[real], owner[real], sentence[real]
    # a word said over and over counts once
    said = np.ones(len(code), dtype=bool)
    said[1:] = (code[1:] != code[:-1]) | (sentence[1:] != sentence[:-1])
    code, owner, sentence = code[said], owner[said], sentence[said]
    new = np.ones(len(code), dtype=bool)
    new[1:] = sentence[1:] != sentence[:-1]
    first = np.flatnonzero(new)
    inside = np.arange(len(code)) - np.repeat(first, np.diff(np.append(first, len(code))))
    first = np.flatnonzero(inside % LONGEST == 0)
    return code, table, first, owner[first]


def _log_not(code: np.ndarray, table: np.ndarray, first: np.ndarray, weights: np.ndarray, bias: float) -> np.ndarray:
    """log(1 - p) of each sentence."""
    if not len(first):
        return np.zeros(0)
    total = np.add.reduceat(weights[table].sum(axis=1)[code], first) + bias
    return -np.logaddexp(0.0, total)


def _telling(seen_toxic: np.ndarray, seen: np.ndarray, rate: float, evidence: float) -> np.ndarray:
    """Features more frequent in toxic documents than chance allows, by the likelihood ratio."""
    with np.errstate(divide="ignore", invalid="ignore"):
        clean = seen - seen_toxic
        a = np.where(seen_toxic > 0, seen_toxic * np.log(seen_toxic / (seen * rate)), 0.0)
        b = np.where(clean > 0, clean * np.log(clean / (seen * (1 - rate))), 0.0)
        return (seen_toxic > seen * rate) & (2 * (a + b) >= evidence)


def _seen(texts: pa.Array, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents with each feature, and toxic ones among them."""
    code, table, first, owner = _sentences(texts)
    if not len(code):
        return np.zeros(BUCKETS), np.zeros(BUCKETS)
    spans = np.diff(np.append(first, len(code)))
    met = np.unique(np.repeat(owner, spans) * len(table) + code)
    pair = np.unique(np.repeat(met // len(table), 3) * BUCKETS + table[met % len(table)].ravel())
    feature = pair % BUCKETS
    return np.bincount(feature, minlength=BUCKETS).astype(float), np.bincount(feature, y[pair // BUCKETS], minlength=BUCKETS)


def _telling_words(texts: pa.Array, telling: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the words with a telling one, the sentence of each word, and the text of each sentence."""
    code, table, first, owner = _sentences(texts)
    spans = np.diff(np.append(first, len(code)))
    kept = telling[table].any(axis=1)[code] if len(code) else np.zeros(0, dtype=bool)
    return table[code[kept]], np.repeat(np.arange(len(first)), spans)[kept], owner


def fit(texts: pa.Array, toxic: np.ndarray, epochs: int = EPOCHS, bias: float = -9.0, penalty: float = 1e-6,
        evidence: float = 20.0, at_once: int = 256) -> tuple[np.ndarray, float]:
    """Feature weights and bias that make the noisy-or fit the document labels.

    Only features whose count in toxic documents is beyond chance (likelihood
    ratio of ``evidence`` or more) get a weight; full-batch gradient steps fit
    these, each with a rate of its own. Both labels weigh the same in total.
    Texts are taken apart ``at_once`` at a time; only the words with a telling
    feature are kept.
    """
    weights = np.zeros(BUCKETS)
    y = toxic.astype(float)
    if not 0 < y.sum() < len(y):
        return weights, bias
    starts = range(0, len(y), at_once)
    seen, seen_toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for start in starts:
        all_, bad = _seen(texts.slice(start, at_once), y[start:start + at_once])
        seen += all_
        seen_toxic += bad
    telling = _telling(seen_toxic, seen, y.mean(), evidence)
    words, sentences, owners, count = [], [], [], 0
    for start in starts:
        word, sentence, owner = _telling_words(texts.slice(start, at_once), telling)
        words.append(word)
        sentences.append(sentence + count)
        owners.append(owner + start)
        count += len(owner)
    word, sentence, owner = np.concatenate(words), np.concatenate(sentences), np.concatenate(owners)
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())
    squares, bias_squares = np.full(BUCKETS, share.mean() ** 2), 1e-12
    for _ in range(epochs):
        total = np.bincount(sentence, weights[word].sum(axis=1), minlength=count) + bias
        clean = -np.logaddexp(0.0, total)
        none = np.bincount(owner, clean, minlength=len(y))
        odds = np.exp(none) / np.maximum(-np.expm1(none), 1e-9)
        pull = np.where(y > 0, np.minimum(odds, 1e6), -1.0) * share
        slope = -np.expm1(clean) * pull[owner]
        gradient = np.bincount(word.ravel(), np.repeat(slope[sentence], 3), minlength=BUCKETS) - penalty * weights
        gradient[~telling] = 0.0
        squares += gradient**2
        weights += gradient / np.sqrt(squares)
        down = slope.sum()
        bias_squares += down**2
        bias = min(bias + 0.1 * down / np.sqrt(bias_squares), -8.0)
    return weights, bias


def training_rows(docs: DataFrame, labels: DataFrame, trains: Column, sample: int, id_column: str, text_column: str,
                  label_column: str) -> tuple[pa.Array, np.ndarray]:
    """Up to ``sample`` labelled texts of either label, chosen by a hash of the id."""
    known = labels.select(F.col(id_column).alias("id"), F.col(label_column).alias("toxic")).where(
        "id is not null and toxic in (0, 1)"
    )
    rows = docs.where(trains).select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    )
    present = known.join(rows.select("id"), "id", "left_semi")
    chosen = reduce(DataFrame.union, [
        present.where(F.col("toxic") == label).orderBy(F.xxhash64("id"), "id").limit(sample) for label in (0, 1)
    ])
    table = rows.join(F.broadcast(chosen), "id").select("id", "text", "toxic").toArrow()
    table = table.sort_by([("id", "ascending"), ("text", "ascending"), ("toxic", "ascending")])
    return table.column("text").combine_chunks(), table.column("toxic").to_numpy()


def train(docs: DataFrame, labels: DataFrame, trains: Column, id_column: str = "doc_id", text_column: str = "text",
          label_column: str = "toxic", sample: int = SAMPLE, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Fits on at most ``sample`` documents of either label for which ``trains`` holds; without any, all are clean."""
    return fit(*training_rows(docs, labels, trains, sample, id_column, text_column, label_column), epochs)


def _apply(docs: DataFrame, model: tuple[np.ndarray, float], text_column: str, extra: dict[str, str], results) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    place = names.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for batch in batches:
            for part in slices(batch, names[place]):
                text = pc.fill_null(part.column(place).cast(pa.string()), "")
                code, table, first, owner = _sentences(text)
                clean = _log_not(code, table, first, weights, bias)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *results(text, clean, owner)], names=[*names, *extra]
                )

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(run, ", ".join(fields + [f"`{k}` {v}" for k, v in extra.items()]))


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores while ``docs`` has a column of that name in any case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def score(docs: DataFrame, model: tuple[np.ndarray, float], text_column: str = "text", name: str = "toxicity") -> DataFrame:
    """``docs`` with the probability that some sentence is toxic, as column ``name``.

    Every row is scored on its own and its whole text. Null, empty and wordless
    texts score 0; a very long text is scored sentence by sentence like any
    other. Repeated rows score the same, so ties are equal scores, and an empty
    table gives no rows. If ``docs`` has a column called ``name`` in any case,
    the score's name gets underscores (``free_name``).
    """
    name = free_name(docs, name)
    return _apply(docs, model, text_column, {name: "double"}, lambda text, clean, owner: [
        pa.array(np.abs(-np.expm1(np.bincount(owner, clean, minlength=len(text)).astype(float)))),
    ])


def offending_sentences(docs: DataFrame, model: tuple[np.ndarray, float], id_column: str = "doc_id",
                        text_column: str = "text", cut: float = 0.5) -> DataFrame:
    """``doc_id``, ``sentence`` (from 0) and ``score`` of the sentences that score ``cut`` or more."""
    def per_sentence(text, clean, owner):
        counts = np.bincount(owner, minlength=len(text))
        offsets = np.concatenate([[0], np.cumsum(counts)])
        return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(-np.expm1(clean)))]

    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    scored = _apply(rows, model, "text", {"scores": "array<double>"}, per_sentence)
    return scored.select("doc_id", F.posexplode("scores").alias("sentence", "score")).where(F.col("score") >= cut)


def reject_toxic(docs: DataFrame, model: tuple[np.ndarray, float], text_column: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that score below ``cut``, all columns kept, whatever their names."""
    name = free_name(docs, "toxicity")
    return score(docs, model, text_column, name).where(F.col(name) < cut).drop(name)


ship_with_jobs(__name__)
