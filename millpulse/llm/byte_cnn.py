"""Quality classifier: a byte-level convolutional network in numpy.

A document's UTF-8 bytes are cut into chunks that overlap, so that every byte
and every filter position is covered. Each chunk goes through byte embeddings, a
strided convolution and ReLU, and is max-pooled over its positions; the chunks'
features are combined into one probability by their mean and their maximum.

Embedding and filter of one offset only ever act together, so scoring adds rows
of one small table for each offset. Training (Adam, full backpropagation through
the pooled positions) uses at most ``TRAIN_DOCS`` labelled documents of each
class, of at most ``TRAIN_CHARS``, from rows whose crc32 of the id is not
divisible by five. Scoring covers whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millpulse.llm.common import stored, table

TRAIN_DOCS = 1000
TRAIN_CHARS = 20_000
EPOCHS = 12
BATCH = 32
CHUNK = 1024
WIDTH = 6
STRIDE = 2
EMBEDDED = 8
FILTERS = 16
THRESHOLD = 0.3


def is_held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 5 == 0


def chunks_of(data: bytes, chunk: int = CHUNK) -> list[np.ndarray]:
    """Chunks that share WIDTH - STRIDE bytes with the next one: each filter
    position lies in exactly one. Short texts are padded with spaces."""
    if len(data) < WIDTH:
        data = data + b" " * (WIDTH - len(data))
    if (len(data) - WIDTH) % STRIDE:
        data += b" "
    x = np.frombuffer(data, dtype=np.uint8)
    positions = (len(x) - WIDTH) // STRIDE + 1
    each = (chunk - WIDTH) // STRIDE + 1
    return [
        x[p * STRIDE : (min(p + each, positions) - 1) * STRIDE + WIDTH] for p in range(0, positions, each)
    ]


@dataclass
class ByteNet:
    embedding: np.ndarray  # 256 x EMBEDDED
    filters: np.ndarray  # WIDTH x EMBEDDED x FILTERS
    bias: np.ndarray  # FILTERS
    output: np.ndarray  # 2 * FILTERS
    offset: np.ndarray  # 1

    @classmethod
    def start(cls, seed: int = 0) -> ByteNet:
        r = np.random.default_rng(seed)
        f32 = np.float32
        return cls(
            r.normal(0, 0.5, (256, EMBEDDED)).astype(f32),
            r.normal(0, (WIDTH * EMBEDDED) ** -0.5, (WIDTH, EMBEDDED, FILTERS)).astype(f32),
            np.zeros(FILTERS, f32),
            np.zeros(2 * FILTERS, f32),
            np.zeros(1, f32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.bias, self.output, self.offset]

    def tables(self) -> np.ndarray:
        """What a byte adds to every filter, by its offset: WIDTH x 256 x FILTERS."""
        return np.einsum("be,wef->wbf", self.embedding, self.filters)

    def activations(self, chunk: np.ndarray, tables: np.ndarray) -> np.ndarray:
        n = (len(chunk) - WIDTH) // STRIDE + 1
        total = tables[0][chunk[0 : n * STRIDE : STRIDE]]
        for w in range(1, WIDTH):
            total += tables[w][chunk[w : w + n * STRIDE : STRIDE]]
        return total

    def pooled(self, chunks: list[np.ndarray], tables: np.ndarray) -> np.ndarray:
        rows = np.stack([self.activations(c, tables).max(axis=0) for c in chunks])
        return np.maximum(rows + self.bias, 0)

    def score(self, text: str | None, tables: np.ndarray) -> float:
        rows = self.pooled(chunks_of((text or "").encode("utf-8", "surrogatepass")), tables)
        z = float(np.concatenate([rows.mean(axis=0), rows.max(axis=0)]) @ self.output + self.offset[0])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(docs: list[tuple[str, int]], epochs: int = EPOCHS, rate: float = 0.01, seed: int = 0) -> ByteNet:
    """Cross-entropy with both classes of equal weight."""
    net = ByteNet.start(seed)
    y = np.array([label for _, label in docs], dtype=np.float32)
    if not len(docs):
        return net
    chunked = [chunks_of(t.encode("utf-8", "surrogatepass")) for t, _ in docs]
    share = np.bincount(y.astype(int), minlength=2) / len(y)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    rng, step = np.random.default_rng(seed), 0
    for _ in range(epochs):
        order = rng.permutation(len(docs))
        for k in range(0, len(order), BATCH):
            part = order[k : k + BATCH]
            tables = net.tables()
            grads = [np.zeros_like(p) for p in net.parameters()]
            for i in part:
                chunks = chunked[i]
                at = np.empty((len(chunks), FILTERS), dtype=np.int64)
                raw = np.empty((len(chunks), FILTERS), dtype=np.float32)
                for c, chunk in enumerate(chunks):
                    act = net.activations(chunk, tables)
                    at[c] = act.argmax(axis=0)
                    raw[c] = act[at[c], np.arange(FILTERS)] + net.bias
                rows = np.maximum(raw, 0)
                feature = np.concatenate([rows.mean(axis=0), rows.max(axis=0)])
                p = 1 / (1 + np.exp(-np.clip(feature @ net.output + net.offset[0], -30, 30)))
                d = (p - y[i]) / (2 * max(share[int(y[i])], 1e-9)) / len(part)
                grads[3] += d * feature
                grads[4] += d
                back = np.repeat(d * net.output[None, :FILTERS] / len(chunks), len(chunks), axis=0)
                back[rows.argmax(axis=0), np.arange(FILTERS)] += d * net.output[FILTERS:]
                back *= raw > 0
                grads[2] += back.sum(axis=0)
                for c, chunk in enumerate(chunks):
                    seen = chunk[at[c][:, None] * STRIDE + np.arange(WIDTH)]  # FILTERS x WIDTH
                    inner = net.embedding[seen]  # FILTERS x WIDTH x EMBEDDED
                    grads[1] += np.einsum("f,fwe->wef", back[c], inner)
                    np.add.at(grads[0], seen, np.einsum("f,wef->fwe", back[c], net.filters))
            step += 1
            for p, g, (m, v) in zip(net.parameters(), grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def training_rows(
    docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_DOCS, chars: int = TRAIN_CHARS
) -> list[tuple[str, int]]:
    """At most ``per_class`` texts of each class, none of them held out."""
    chosen = None
    for quality in (0, 1):
        part = (
            labels.where(F.col("quality") == quality).where("doc_id IS NOT NULL")
            .where(~is_held_out(F.col("doc_id")))
            .select(F.col("doc_id").alias("label_id"), F.col("quality").alias("label"))
            .orderBy(F.xxhash64(F.lit(9), "label_id"), "label_id").limit(per_class)
        )
        chosen = part if chosen is None else chosen.union(part)
    chosen = stored(chosen, "cnn-sample")  # at most 2 * per_class rows of two numbers
    rows = (
        docs.select("doc_id", "text").where(F.length("text") <= chars)
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
        .select("doc_id", "text", "label").collect()
    )
    return [(r.text, int(r.label)) for r in sorted(rows, key=lambda r: (r.doc_id, r.text))]


def score_udf(net: ByteNet):
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tables = net.tables()
        for batch in texts:
            yield pd.Series([net.score(t, tables) for t in batch], dtype="float64")

    scores.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(scores, "double")


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row for each document.

    Null and empty texts are scored as spaces. A null id is held out by no one:
    held_out is false. Without labels every score is one half.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    net = train(training_rows(rows, labels))
    scored = rows.select(
        "doc_id",
        F.coalesce(is_held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        score_udf(net)(F.col("text")).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op9_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_quality(docs, table(spark, sf_dir, "labels"))


QUERIES = {"op9_byte_cnn": op9_byte_cnn}
ORACLE: dict[str, str] = {}
