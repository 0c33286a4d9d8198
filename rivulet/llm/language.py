"""Language ID by a byte convolutional network, trained here in numpy.

A text's UTF-8 bytes are cut into windows of a fixed length, the last one
padded with zero bytes.  Filters of several widths run over embedded bytes; the
largest response of each filter in a window goes through a rectifier into a
softmax over languages.  A text's score is the softmax of its windows' mean log
probabilities, weighted by their bytes, so every byte of every text counts.

For prediction the trained filters are folded into tables over byte pairs: a
response is the sum of at most two table rows.

Training reads a bounded sample: of each language at most ``sample`` labelled
rows (fewer, but at least one, if that would be over 40,000 in all), those whose
hash of id and text is least, and one window of each.

Cases: a text that is null or has no letter is ``und`` with score 0; rows with
null labels are not learned from; a null doc_id has the CRC of an empty string;
repeated rows get equal results; with no labelled row at all every text is
``und``; an empty table gives an empty result; other columns are ignored (lang,
source and doc_id are never inputs of a prediction).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import forget, slices, table

WINDOW = 512
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
SAMPLE = 1500
MOST_ROWS = 40_000
STEPS = 900
BATCH = 64
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # for each width: width x EMBEDDING x FILTERS
    bias: list[np.ndarray]
    weight: np.ndarray  # all filters x languages
    weight_bias: np.ndarray


def windows(raw: list[bytes], length: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows with padding after each, owner of each window, bytes in each window)."""
    size = np.array([len(x) for x in raw], dtype=np.int64)
    n = -(-size // length)
    owner = np.repeat(np.arange(len(raw)), n)
    pad = max(WIDTHS)
    joined = np.frombuffer(b"".join(x + bytes(-len(x) % length) for x in raw), dtype=np.uint8).reshape(-1, length)
    out = np.zeros((len(owner), length + pad), dtype=np.uint8)
    out[:, :length] = joined
    inside = np.full(len(owner), length, dtype=np.int64)
    last = np.cumsum(n)[n > 0] - 1
    inside[last] = (size - (n - 1) * length)[n > 0]
    return out, owner, inside


def forward(model: Model, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Plain forward pass: probabilities, where each filter was largest, and pooled responses."""
    e, length, pooled, where = model.embedding[x], x.shape[1] - max(WIDTHS), [], []
    for w, f, b in zip(WIDTHS, model.filters, model.bias, strict=True):
        y = sum(e[:, j : j + length] @ f[j] for j in range(w))
        at = y.argmax(axis=1)
        where.append(at)
        pooled.append(np.take_along_axis(y, at[:, None], axis=1)[:, 0] + b)
    h = np.concatenate(pooled, axis=1)
    z = np.maximum(h, 0) @ model.weight + model.weight_bias
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True), where, h


def gradients(model: Model, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross entropy, in the order of ``parameters``."""
    p, where, h = forward(model, x)
    n = len(x)
    dz = p
    dz[np.arange(n), y] -= 1
    dz /= n
    a = np.maximum(h, 0)
    dh = (dz @ model.weight.T) * (h > 0)
    de, dfs, dbs = np.zeros_like(model.embedding), [], []
    for k, (w, f) in enumerate(zip(WIDTHS, model.filters, strict=True)):
        g = dh[:, k * FILTERS : (k + 1) * FILTERS]
        df = np.zeros_like(f)
        for j in range(w):
            byte = np.take_along_axis(x, where[k] + j, axis=1)  # n x FILTERS
            df[j] = np.einsum("nfe,nf->ef", model.embedding[byte], g)
            np.add.at(de, byte, g[..., None] * f[j].T[None])
        dfs.append(df)
        dbs.append(g.sum(axis=0))
    return [de, *dfs, *dbs, a.T @ dz, dz.sum(axis=0)]


def parameters(model: Model) -> list[np.ndarray]:
    return [model.embedding, *model.filters, *model.bias, model.weight, model.weight_bias]


def train(texts: list[bytes], labels: list[str], steps: int = STEPS, seed: int = 7) -> Model:
    """Adam over random crops: whole windows and short pieces of them, languages drawn evenly."""
    names = sorted(set(labels))
    rng = np.random.default_rng(seed)
    scale = 1 / np.sqrt(EMBEDDING)
    model = Model(
        names,
        rng.normal(0, 1, (256, EMBEDDING)).astype(np.float32) * np.float32(scale),
        [rng.normal(0, scale / np.sqrt(w), (w, EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(names))).astype(np.float32),
        np.zeros(len(names), np.float32),
    )
    if len(names) < 2:
        return model
    by_name: dict[str, list[bytes]] = {}
    for t, l in zip(texts, labels, strict=True):
        by_name.setdefault(l, []).append(t)
    rows = [by_name[name] for name in names]
    first, second = [np.zeros_like(p) for p in parameters(model)], [np.zeros_like(p) for p in parameters(model)]
    for step in range(1, steps + 1):
        y = rng.integers(len(names), size=BATCH)
        # Every third batch has pieces of a few bytes, as short texts and last windows do.
        most = WINDOW if step % 3 == 0 else 192 if step % 3 == 1 else 48
        x = np.zeros((BATCH, most + max(WIDTHS)), dtype=np.uint8)
        for i, k in enumerate(y.tolist()):
            t = rows[k][rng.integers(len(rows[k]))]
            size = min(len(t), most if step % 3 == 0 else int(rng.integers(6, most + 1)))
            a = int(rng.integers(len(t) - size + 1))
            x[i, :size] = np.frombuffer(t, dtype=np.uint8, count=size, offset=a)
        rate = 0.01 * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, m, v in zip(parameters(model), gradients(model, x, y), first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)).astype(np.float32)
    return model


class Predictor:
    """The trained network with its filters folded into tables over pairs of bytes."""

    ROWS = 2048

    def __init__(self, model: Model) -> None:
        self.model = model
        e = model.embedding
        t = [[e @ f[j] for j in range(len(f))] for f in model.filters]
        pair = lambda a, b: (a[:, None] + b[None]).reshape(1 << 16, -1)  # noqa: E731  index: first byte * 256 + second
        none = np.zeros_like(t[1][2])
        # Widths 2, 3 and 4 over the pair at a position; widths 3 and 4 over the pair two further on.
        self.near = np.ascontiguousarray(np.concatenate([pair(t[0][0], t[0][1]), pair(t[1][0], t[1][1]), pair(t[2][0], t[2][1])], axis=1), dtype=np.float32)
        self.far = np.ascontiguousarray(np.concatenate([pair(t[1][2], none), pair(t[2][2], t[2][3])], axis=1), dtype=np.float32)
        self.bias = np.concatenate(model.bias)

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        """Of windows with their padding."""
        out = np.empty((len(x), len(self.model.languages)), dtype=np.float32)
        for at in range(0, len(x), self.ROWS):
            part = x[at : at + self.ROWS]
            pairs = np.ascontiguousarray((part[:, :-1].astype(np.int64) << 8 | part[:, 1:]).T)
            best = np.full((len(part), self.near.shape[1]), -np.inf, dtype=np.float32)
            y, z = np.empty_like(best), np.empty((len(part), self.far.shape[1]), dtype=np.float32)
            for i in range(x.shape[1] - max(WIDTHS)):
                np.take(self.near, pairs[i], axis=0, out=y, mode="clip")
                np.take(self.far, pairs[i + 2], axis=0, out=z, mode="clip")
                y[:, FILTERS:] += z
                np.maximum(best, y, out=best)
            s = np.maximum(best + self.bias, 0) @ self.model.weight + self.model.weight_bias
            s -= s.max(axis=1, keepdims=True)
            out[at : at + self.ROWS] = s - np.log(np.exp(s).sum(axis=1, keepdims=True))
        return out

    def predict(self, raw: list[bytes]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text (texts without bytes get ``und``)."""
        names = self.model.languages
        if not names:
            return [UNKNOWN] * len(raw), np.zeros(len(raw))
        total = np.zeros((len(raw), len(names)))
        x, owner, inside = windows(raw)
        if len(x):
            np.add.at(total, owner, self.log_probabilities(x) * inside[:, None].astype(np.float64))
        size = np.array([len(t) for t in raw], dtype=np.float64)
        mean = total / np.maximum(size, 1)[:, None]
        p = np.exp(mean - mean.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        score = np.where(size > 0, p[np.arange(len(raw)), best], 0.0)
        return [names[i] if n else UNKNOWN for i, n in zip(best.tolist(), size.tolist(), strict=True)], score


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")), F.lit(4)) == 2


def learn(docs: DataFrame, sample: int = SAMPLE, steps: int = STEPS) -> Model:
    """A model of the labelled rows that are not held out, from at most ``sample`` rows a language."""
    labelled = docs.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    # One row a language, as the network itself has.
    count = {r[0]: r[1] for r in labelled.where(F.col("text").rlike(r"\p{L}")).groupBy("lang").count().collect()}
    texts, labels = [], []
    if count:
        sample = min(sample, max(1, MOST_ROWS // len(count)))
        # A hash below this share of its range keeps somewhat more than the sample; the row number makes it exact.
        shares = docs.sparkSession.createDataFrame([(k, min(1.0, 1.5 * sample / n + 30 / n)) for k, n in count.items()], "rv_lang string, rv_share double")
        h = F.xxhash64(F.col("doc_id").cast("string"), "text")
        draw = F.shiftrightunsigned(h, 11).cast("double") / F.lit(float(1 << 53))
        start = F.pmod(h, F.greatest(F.length("text") - WINDOW, F.lit(0)) + 1).cast("int") + 1
        drawn = labelled.where(F.col("text").rlike(r"\p{L}")).join(F.broadcast(shares), F.col("lang") == F.col("rv_lang")).where(draw < F.col("rv_share"))
        rows = drawn.select("lang", draw.alias("draw"), F.substring(F.col("text"), start, F.lit(WINDOW)).alias("piece"))
        nth = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "piece"))
        for r in sorted(rows.withColumn("nth", nth).where(F.col("nth") <= sample).collect(), key=lambda r: (r["draw"], r["lang"], r["piece"])):
            texts.append(r["piece"].encode()[:WINDOW])
            labels.append(r["lang"])
    return train(texts, labels, steps)


def predict(docs: DataFrame, model: Model, column: str = "text", added: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and its score, in two ``added`` columns."""
    from pyspark.sql.types import DoubleType, StringType, StructType

    names = docs.columns
    at = names.index(column)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        predictor = Predictor(sent.value)
        for b in slices(batches, f"c{at}"):
            texts = b.column(at).to_pylist()
            raw = [t.encode("utf-8", "replace") if t and any(map(str.isalpha, t)) else b"" for t in texts]
            lang, score = predictor.predict(raw)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*names, *added])

    # Places as names on the way in, as a column's own name may have a dot.
    return docs.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(run, StructType([*docs.schema.fields]).add(added[0], StringType()).add(added[1], DoubleType()))


def identify(docs: DataFrame, sample: int = SAMPLE, steps: int = STEPS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document."""
    model = learn(docs, sample, steps)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
