"""Quality scores by a factorisation machine over hashed words, structure statistics and metadata.

Every document is a vector: the share of its words in each of ``BUCKETS`` hash buckets, shares of kinds of characters
and lines, and its stated length against the real one. The model has a weight and a short vector of factors for each input
and scores all pairs of inputs through the identity  sum over pairs = (square of sum - sum of squares) / 2,  in time
linear in the inputs. It is fitted on at most ``most`` labelled documents (a bound that does not grow), on the
driver, whose part is vectors of a few thousand numbers; every document is scored where it lies.

Defined cases: a null text counts as empty; an empty text gets the score of a vector of zeros. A null or missing n_chars
counts as right. A null doc_id is never learnt from and its held_out is null. Repeated rows are scored each. If no
label or only one kind is known, every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import batch, by_text, read_table, texts_of
from churnkit.llm.registry import query
from churnkit.llm.training import labelled_sample, remainder
from churnkit.llm.words import mix, split_words

BUCKETS = 2048
FACTORS = 8
_BLANKS = " \t\n\x0b\x0c\r"
_SHAPES = 12


def _marked(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


_UPPER, _DIGIT = _marked((65, 90)), _marked((48, 57))
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LOUD = np.zeros(256, bool)
_LOUD[list(b"!?")] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:")] = True


def _shape(texts: list[str], stated: np.ndarray, words) -> np.ndarray:
    """Structure statistics and metadata, each between 0 and about 1."""
    n = np.maximum(np.diff(words.first), 1)
    size = np.maximum(words.bytes_per_doc(np.ones(len(words.data), bool)), 1)
    hashes = words.hashes()
    doc = words.doc
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    length = words.end - words.start
    upper_word = np.zeros(len(hashes), bool)
    if len(hashes):
        ups = np.concatenate([[0], np.cumsum(_UPPER[words.data])])
        upper_word = (ups[words.end] - ups[words.start]) * 2 > length
    repeated = np.zeros(len(texts))
    for i, t in enumerate(texts):
        lines = [x for x in t.split("\n") if x.strip(_BLANKS)]
        repeated[i] = 1 - len(set(lines)) / len(lines) if lines else 0
    chars = np.array([len(t) for t in texts])
    stated = np.where(np.isnan(stated), chars, stated)
    return np.column_stack([
        words.bytes_per_doc(_UPPER[words.data]) / size,
        words.bytes_per_doc(_DIGIT[words.data]) / size,
        np.minimum(words.bytes_per_doc(_SYMBOL[words.data]) / n, 3) / 3,
        np.minimum(words.bytes_per_doc(_LOUD[words.data]) / n, 2) / 2,
        np.minimum(words.bytes_per_doc(_STOP[words.data]) / n, 1),
        words.words_per_doc(again) / n,
        words.words_per_doc(upper_word) / n,
        words.words_per_doc(length > 20) / n,
        np.minimum(words.words_per_doc(np.ones(len(hashes), bool)) / 20, 1),
        repeated,
        np.minimum(np.log1p(n) / 12, 1),
        np.minimum(np.abs(np.log1p(stated) - np.log1p(chars)), 1),
    ])


def vectors(texts: list[str], stated: np.ndarray) -> np.ndarray:
    """One row per text: shares of words by bucket (square roots), then the shape."""
    words = split_words([t.encode() for t in texts], lower=True)
    shape = _shape(texts, stated, split_words([t.encode() for t in texts]))
    bucket = (mix(words.hashes()) % np.uint64(BUCKETS)).astype(np.int64)
    counts = np.bincount(words.doc * BUCKETS + bucket, minlength=len(texts) * BUCKETS).reshape(len(texts), BUCKETS)
    shares = np.sqrt(counts / np.maximum(np.diff(words.first), 1)[:, None])
    return np.hstack([shares, shape]).astype(np.float32)


class Machine:
    """bias + w x + sum over factors of ((x V)^2 - x^2 V^2) / 2, through the logistic function."""

    def __init__(self, inputs: int, factors: int = FACTORS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.bias = np.float32(0)
        self.w = np.zeros(inputs, np.float32)
        self.v = rng.normal(0, 0.05, (inputs, factors)).astype(np.float32)

    def margin(self, x: np.ndarray) -> np.ndarray:
        s = x @ self.v
        return self.bias + x @ self.w + 0.5 * ((s * s).sum(1) - (x * x) @ (self.v * self.v).sum(1))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x).astype(np.float64), -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int = 30, rate: float = 0.1, decay: float = 1e-5) -> Machine:
        """AdaGrad on the logistic loss, both labels weighing the same; the order of rows is fixed."""
        share = float(y.mean()) if len(y) else 0.5
        if not len(y) or not 0 < share < 1:
            share = min(max(share, 1e-3), 1 - 1e-3)
            self.bias, self.v = np.float32(np.log(share / (1 - share))), self.v * 0
            return self
        weight = np.where(y > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        rng = np.random.default_rng(11)
        sums = [np.float32(1e-6), np.full_like(self.w, 1e-6), np.full_like(self.v, 1e-6)]
        for _ in range(rounds):
            order = rng.permutation(len(y))
            for i in range(0, len(y), 256):
                rows = order[i : i + 256]
                b = x[rows]
                g = ((self.score(b) - y[rows]) * weight[rows] / len(rows)).astype(np.float32)
                s = b @ self.v
                parts = [
                    g.sum(),
                    b.T @ g + decay * self.w,
                    b.T @ (g[:, None] * s) - self.v * ((b * b).T @ g)[:, None] + decay * self.v,
                ]
                for k, (name, grad) in enumerate(zip(("bias", "w", "v"), parts)):
                    sums[k] = sums[k] + grad * grad
                    setattr(self, name, getattr(self, name) - rate * grad / np.sqrt(sums[k]))
        return self


def _inputs(docs: DataFrame) -> DataFrame:
    stated = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.lit(None).cast("double")
    return docs.select("doc_id", "text", stated.alias("stated"))


def _stated(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column, float("nan")).to_numpy(zero_copy_only=False)


def train(docs: DataFrame, labels: DataFrame, label: str, allowed, most: int) -> Machine:
    sample = labelled_sample(_inputs(docs), labels, label, allowed, most)
    schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("vector", pa.binary())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in by_text(b, "text", 1 << 20):
                own = b.slice(part.start, part.stop - part.start)
                x = vectors(texts_of(own.column("text")), _stated(own.column("stated"))).astype(np.float16)
                yield batch(schema, own.column("doc_id"), own.column("label").cast(pa.int32()), [r.tobytes() for r in x])

    rows = sample.mapInArrow(extract, "doc_id long, label int, vector binary").orderBy("doc_id", "vector").collect()
    x = np.frombuffer(b"".join(r.vector for r in rows), np.float16).reshape(-1, BUCKETS + _SHAPES).astype(np.float32)
    return Machine(BUCKETS + _SHAPES).fit(x, np.array([r.label for r in rows], np.float32))


def score_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held: int = 0, most: int = 5000
) -> DataFrame:
    """doc_id, held_out and score (0 to 1, higher: label 1 likelier) of every document.

    Learns from at most ``most`` labelled documents whose id's remainder by ``folds`` is not ``held``.
    """
    machine = train(docs, labels, label, remainder(F.col("doc_id"), folds) != held, most)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in by_text(b, "text", 1 << 20):
                own = b.slice(part.start, part.stop - part.start)
                texts, stated = texts_of(own.column("text")), _stated(own.column("stated"))
                scores = [machine.score(vectors(texts[i : i + 512], stated[i : i + 512])) for i in range(0, len(texts), 512)]
                yield batch(schema, own.column("doc_id"), np.concatenate(scores))

    scored = _inputs(docs).mapInArrow(score, "doc_id long, score double")
    held_out = remainder(F.col("doc_id"), folds) == held
    return scored.select("doc_id", held_out.alias("held_out"), "score")


@query()
def op6_quality_classifier(spark, sf_dir):
    """Quality score of every document."""
    scored = score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
