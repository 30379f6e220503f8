"""Language of texts by a byte convolutional network, trained in numpy and applied in batches."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import map_batches

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 12
# The training sample: rows of each language at most, and characters of each row around a hashed place.
ROWS_PER_LANGUAGE = 600
SAMPLE_CHARS = 512
# Languages that are learned at most, the most frequent ones; a column with more names is no label.
LANGUAGES = 500
_BATCH = 64


@dataclass
class Network:
    """Embedding, filters of several widths, max pooling over a window, and a softmax layer."""

    labels: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]  # width x EMBEDDING x FILTERS
    biases: list[np.ndarray]
    weights: np.ndarray
    offset: np.ndarray

    def tables(self) -> list[np.ndarray]:
        """For each width, what a byte adds to the filters at each place: a convolution becomes sums of rows."""
        return [np.ascontiguousarray(np.einsum("be,wef->wbf", self.embedding, x), np.float32) for x in self.filters]


def windows(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of all texts in windows of ``size`` (the last one of a text padded with 0), and each window's text."""
    counts = [max(1, -(-len(x) // size)) for x in texts]
    padded = b"".join(x.ljust(n * size, b"\0") for x, n in zip(texts, counts, strict=True))
    return np.frombuffer(padded, np.uint8).reshape(-1, size), np.repeat(np.arange(len(texts)), counts)


def train(samples: list[tuple[str, str]], *, epochs: int = 6, rate: float = 0.01, seed: int = 7) -> Network:
    """Fit by Adam on windows of (text, language) pairs; each language weighs the same."""
    labels = sorted({lang for _, lang in samples})
    rng = np.random.default_rng(seed)
    x, owner = windows([text.encode() for text, _ in samples])
    y = np.array([labels.index(lang) for _, lang in samples])[owner]
    weight = (len(y) / (len(labels) * np.bincount(y, minlength=len(labels))))[y] if len(labels) else np.zeros(0)
    net = Network(
        labels, rng.normal(0, 0.5, (256, EMBEDDING)),
        [rng.normal(0, (w * EMBEDDING) ** -0.5, (w, EMBEDDING, FILTERS)) for w in WIDTHS], [np.zeros(FILTERS) for _ in WIDTHS],
        rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(labels))), np.zeros(len(labels)),
    )
    params = [net.embedding, *net.filters, *net.biases, net.weights, net.offset]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(epochs if len(labels) > 1 else 0):
        order = rng.permutation(len(x))
        for i in range(0, len(order), _BATCH):
            pick = order[i : i + _BATCH]
            step += 1
            for p, g, m, v in zip(params, _gradients(net, x[pick], y[pick], weight[pick]), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def _gradients(net: Network, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    n, size = x.shape
    e = net.embedding[x]
    pooled, at = [], []
    for filters, bias in zip(net.filters, net.biases, strict=True):
        w = len(filters)
        z = sum(e[:, k : size - w + 1 + k] @ filters[k] for k in range(w)) + bias
        at.append(z.argmax(1))
        pooled.append(np.maximum(np.take_along_axis(z, at[-1][:, None], 1)[:, 0], 0))
    h = np.concatenate(pooled, 1)
    p = _softmax(h @ net.weights + net.offset)
    p[np.arange(n), y] -= 1
    p *= weight[:, None] / n
    dh = (p @ net.weights.T) * (h > 0)
    de, d_filters, d_biases = np.zeros_like(net.embedding), [], []
    for j, filters in enumerate(net.filters):
        d = dh[:, j * FILTERS : (j + 1) * FILTERS]  # n x FILTERS, each at the place of its maximum
        places = at[j][..., None] + np.arange(len(filters))  # n x FILTERS x width
        own = x[np.arange(n)[:, None, None], places]
        d_filters.append(np.einsum("nfwe,nf->wef", net.embedding[own], d))
        d_biases.append(d.sum(0))
        np.add.at(de, own, np.einsum("nf,wef->nfwe", d, filters))
    return [de, *d_filters, *d_biases, h.T @ p, p.sum(0)]


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def predict(net: Network, tables: list[np.ndarray], texts: list[bytes]) -> np.ndarray:
    """Mean probabilities of each text over all its windows, in batches of windows."""
    x, owner = windows(texts)
    out = np.empty((len(x), len(net.labels)))
    for i in range(0, len(x), _BATCH):
        part = x[i : i + _BATCH]
        pooled = []
        for table, bias in zip(tables, net.biases, strict=True):
            w, size = len(table), part.shape[1]
            z = table[0][part[:, : size - w + 1]]
            for k in range(1, w):
                z += table[k][part[:, k : size - w + 1 + k]]
            pooled.append(np.maximum(z.max(1) + bias, 0))
        out[i : i + _BATCH] = _softmax(np.concatenate(pooled, 1) @ net.weights + net.offset)
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    return np.add.reduceat(out, starts) / np.diff(starts, append=len(x))[:, None] if len(x) else out


def has_letter(text: str) -> bool:
    """Number signs such as a half or a raised two are no letters."""
    return any(map(str.isalpha, text))


def sample(labelled: DataFrame, *, rows: int = ROWS_PER_LANGUAGE, chars: int = SAMPLE_CHARS, languages: int = LANGUAGES) -> list[tuple[str, str]]:
    """A bounded sample of (text, lang): ``rows`` of each language by hash order, ``chars`` of each from a hashed place.

    Of more than ``languages`` languages the most frequent ones are taken, of equals the first.

    The rank is cut within each map task, so a frequent language sends ``rows`` rows per task.
    """
    from pyspark.sql import Window

    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0))
    place = F.greatest(F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - chars, F.lit(1))), F.lit(0)) + 1
    frequent = usable.groupBy(F.col("lang").cast("string").alias("lang")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    piece = usable.select(F.col("lang").cast("string").alias("lang"), F.substring("text", place.cast("int"), F.lit(chars)).alias("text"), F.xxhash64("text", "doc_id").alias("order"))
    ranked = piece.join(frequent, "lang", "left_semi").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("order", "text"))).where(f"rank <= {rows}")
    found = sorted((r["lang"], r["rank"], r["text"]) for r in ranked.select("lang", "rank", "text").collect())
    return [(text, lang) for lang, _, text in found if has_letter(text)]


def identify(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (its mean probability) of each row's whole text.

    The network is fitted on the driver to a bounded sample of ``labelled`` and sent to the
    tasks (under 100 kB); all windows of a text count the same. A null text, or one without a
    letter, is ``und`` with score 0, as is every text where nothing is labelled. Null and
    repeated doc_ids are predicted row by row; other columns are ignored.
    """
    net = train(sample(labelled))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            langs, scores = ["und"] * len(texts), [0.0] * len(texts)
            known = [i for i, text in enumerate(texts) if net.labels and text and has_letter(text)]
            for begin in range(0, len(known), 256):
                part = known[begin : begin + 256]
                for i, p in zip(part, predict(net, tables, [texts[i].encode() for i in part]), strict=True):
                    langs[i], scores[i] = net.labels[int(p.argmax())], min(1.0, float(p.max()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    return map_batches(rows, run, "doc_id bigint, lang_pred string, score double")
