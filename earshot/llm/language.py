"""Language identification with a byte convolutional network in numpy.

Bytes are embedded, filters of several widths slide over them, the largest
answer of each filter in a window goes to a softmax. Texts are cut into windows
of fixed length that cover them wholly; a text's score is the mean over its
windows, weighted by their bytes. For prediction, embedding and filters are
folded into tables over byte pairs, which give the same numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import restored, slices
from earshot.session import ship_with_jobs

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 6
# labelled texts per language the fit takes at most, and windows of each of them
SAMPLE = 800
WINDOWS_PER_TEXT = 4
EPOCHS = 10
_REACH = max(WIDTHS) - 1
UNKNOWN = "und"


class Network:
    def __init__(self, languages: list[str], seed: int = 11):
        random = np.random.default_rng(seed)
        self.languages = languages
        self.embedding = random.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)
        self.embedding[0] = 0
        self.filters = [random.normal(0, 1 / np.sqrt(w * EMBEDDING), (w * EMBEDDING, FILTERS)).astype(np.float32)
                        for w in WIDTHS]
        self.biases = [np.zeros(FILTERS, dtype=np.float32) for _ in WIDTHS]
        self.out = random.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), dtype=np.float32)

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.biases, self.out, self.out_bias]

    def _spans(self, x: np.ndarray, width: int) -> np.ndarray:
        """[windows, WINDOW, width * EMBEDDING] of embedded windows x."""
        return np.concatenate([x[:, j:j + WINDOW] for j in range(width)], axis=2)

    def gradient(self, windows: np.ndarray, target: np.ndarray) -> tuple[list[np.ndarray], float]:
        """Gradients for windows of WINDOW + _REACH bytes, and the mean loss."""
        x = self.embedding[windows]
        pooled, kept = [], []
        for width, w, b in zip(WIDTHS, self.filters, self.biases):
            answer = self._spans(x, width) @ w
            best = answer.argmax(axis=1)
            top = np.take_along_axis(answer, best[:, None], axis=1)[:, 0] + b
            pooled.append(np.maximum(top, 0))
            kept.append(best)
        hidden = np.concatenate(pooled, axis=1)
        logits = hidden @ self.out + self.out_bias
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        rows = np.arange(len(target))
        loss = float(-np.log(p[rows, target] + 1e-9).mean())
        p[rows, target] -= 1
        p /= len(target)
        d_hidden = (p @ self.out.T) * (hidden > 0)
        d_embedding = np.zeros_like(self.embedding)
        d_filters, d_biases = [], []
        for i, (width, w) in enumerate(zip(WIDTHS, self.filters)):
            d = d_hidden[:, i * FILTERS:(i + 1) * FILTERS]
            place = kept[i][:, :, None] + np.arange(width)
            bytes_ = windows[rows[:, None, None], place]
            spans = self.embedding[bytes_].reshape(len(target), FILTERS, -1)
            d_filters.append(np.einsum("nf,nfk->kf", d, spans))
            d_biases.append(d.sum(axis=0))
            back = (d[:, :, None] * w.T[None]).reshape(-1, EMBEDDING)
            flat = bytes_.reshape(-1)
            for e in range(EMBEDDING):
                d_embedding[:, e] += np.bincount(flat, back[:, e], minlength=256)
        d_embedding[0] = 0
        return [d_embedding, *d_filters, *d_biases, hidden.T @ p, p.sum(axis=0)], loss

    def fit(self, windows: np.ndarray, target: np.ndarray, epochs: int = EPOCHS, batch: int = 128, rate: float = 0.01,
            seed: int = 5) -> None:
        """Adam over shuffled batches."""
        random = np.random.default_rng(seed)
        first = [np.zeros_like(p) for p in self.parameters()]
        second = [np.zeros_like(p) for p in self.parameters()]
        step = 0
        for epoch in range(epochs):
            order = random.permutation(len(target))
            speed = rate * (1 - epoch / epochs) + 1e-4
            for start in range(0, len(order), batch):
                part = order[start:start + batch]
                step += 1
                for p, g, m, v in zip(self.parameters(), self.gradient(windows[part], target[part])[0], first, second):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= speed * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def tables(self) -> list[tuple[np.ndarray, ...]]:
        """For each width, answers of the filters to byte pairs (and a last single byte)."""
        out = []
        for width, w in zip(WIDTHS, self.filters):
            single = [self.embedding @ w[j * EMBEDDING:(j + 1) * EMBEDDING] for j in range(width)]
            parts = [(single[j][:, None] + single[j + 1][None, :]).reshape(65536, FILTERS) for j in range(0, width - 1, 2)]
            out.append(tuple(parts + ([single[-1]] if width % 2 else [])))
        return out


def _probabilities(network: Network, tables: list, windows: np.ndarray) -> np.ndarray:
    """Softmax of windows of WINDOW + _REACH bytes."""
    pair = windows[:, :-1].astype(np.uint16) << 8 | windows[:, 1:]
    pooled = []
    for width, parts, bias in zip(WIDTHS, tables, network.biases):
        answer = parts[0][pair[:, :WINDOW]]
        for i, part in enumerate(parts[1:], 1):
            at = pair if len(part) == 65536 else windows
            answer += part[at[:, 2 * i:2 * i + WINDOW]]
        pooled.append(np.maximum(answer.max(axis=1) + bias, 0))
    logits = np.concatenate(pooled, axis=1).astype(np.float64) @ network.out.astype(np.float64) + network.out_bias
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits)
    return p / p.sum(axis=1, keepdims=True)


def _in_stretches(network: Network, tables: list, data: list[bytes], counts: np.ndarray, limit: int = 1024):
    """Probabilities of the windows of all texts in order, at most ``limit`` windows at a time.

    Filters at the end of a window see the bytes behind it, at the end of a
    text zeros.
    """
    total = int(counts.sum())
    flat = np.zeros(total * WINDOW + _REACH, dtype=np.uint8)
    start = 0
    for text, count in zip(data, counts):
        flat[start:start + len(text)] = np.frombuffer(text, dtype=np.uint8)
        start += count * WINDOW
    last = np.zeros(total, dtype=bool)
    last[np.cumsum(counts) - 1] = True
    views = np.lib.stride_tricks.sliding_window_view(flat, WINDOW + _REACH)[::WINDOW]
    for first in range(0, total, limit):
        windows = views[first:first + limit].copy()
        windows[last[first:first + limit], WINDOW:] = 0
        yield _probabilities(network, tables, windows)


def train(docs: DataFrame, trains: Column, text_column: str = "text", language_column: str = "lang",
          id_column: str = "doc_id", sample: int = SAMPLE, epochs: int = EPOCHS) -> Network | None:
    """Fits on at most ``sample`` texts per language for which ``trains`` holds; None if there are none.

    The texts with the smallest hashes of their ids are taken, and of each a
    few windows spread over it. Null languages and null or blank texts teach
    nothing. Sizes come out as rare languages have them: every language weighs
    by its windows. Every language that has a text is learned.
    """
    labelled = docs.where(trains & F.col(language_column).isNotNull() & (F.trim(F.col(text_column)) != "")).select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(language_column).alias("lang")
    )
    counts = labelled.groupBy("lang").count().collect()
    if not counts:
        return None
    # about twice as many as wanted by chance, then the first of them by hash
    scale = float(1 << 30)
    chances = docs.sparkSession.createDataFrame(
        [(r["lang"], min(1.0, 2.0 * sample / r["count"] + 1e-4)) for r in counts], "lang string, chance double"
    )
    drawn = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / scale
    pieces = F.array(*[
        F.substring(F.col("text"), (F.floor(F.length("text") * i / WINDOWS_PER_TEXT) + 1).cast("int"), WINDOW + _REACH)
        for i in range(WINDOWS_PER_TEXT)
    ])
    rows = (
        labelled.join(F.broadcast(chances), "lang").where(drawn < F.col("chance"))
        .select("lang", "id", drawn.alias("drawn"), pieces.alias("pieces")).toPandas()
    )
    rows = rows.assign(held=rows["pieces"].map(tuple)).sort_values(["lang", "drawn", "id", "held"])
    names = sorted(r["lang"] for r in counts)
    windows, target = [], []
    for name, group in rows.groupby("lang"):
        for own in group["pieces"].iloc[:sample]:
            for piece in set(own):
                data = piece.encode("utf-8", "replace")[:WINDOW + _REACH]
                if data:
                    windows.append(np.frombuffer(data.ljust(WINDOW + _REACH, b"\0"), dtype=np.uint8))
                    target.append(names.index(name))
    network = Network(names)
    if windows:
        network.fit(np.stack(windows), np.array(target), epochs)
    return network


def predict(docs: DataFrame, network: Network | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` for every row, read from the whole text.

    Texts without a letter, empty and null ones get ``und`` and score 0, and
    so does every text if there is no network. Ties go to the first language
    by name. Rows are independent, repeated rows get equal results.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vars(network) if network else None)
    made: dict[str, list] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = restored(Network, shared.value) if shared.value else None
        tables = made.get("tables") or made.setdefault("tables", net.tables() if net else [])
        for batch in batches:
            for part in slices(batch, limit=1 << 19):
                texts = part.column("text").to_pylist()
                lettered = np.array([any(map(str.isalpha, t)) for t in texts], dtype=bool)
                best, score = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts))
                if net and lettered.any():
                    data = [t.encode("utf-8", "replace") for t in texts]
                    counts = np.array([max(1, -(-len(d) // WINDOW)) for d in data])
                    owner = np.repeat(np.arange(len(texts)), counts)
                    weight = np.full(len(owner), WINDOW, dtype=np.int64)
                    weight[np.cumsum(counts) - 1] = np.array([max(1, len(d) - (c - 1) * WINDOW) for d, c in zip(data, counts)])
                    p = np.concatenate(list(_in_stretches(net, tables, data, counts)))
                    total = np.stack([np.bincount(owner, p[:, k] * weight, minlength=len(texts))
                                      for k in range(p.shape[1])], axis=1)
                    total /= total.sum(axis=1, keepdims=True)
                    best = total.argmax(axis=1)
                    score = np.clip(np.where(lettered, total.max(axis=1), 0.0), 0.0, 1.0)
                names = [net.languages[b] if ok and net else UNKNOWN for b, ok in zip(best, lettered)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


ship_with_jobs(__name__)
