"""Toxicity by a support vector machine over a subsequence string kernel with Nyström landmarks.

Two words are alike as far as they share subsequences of three characters, each weighed down by the stretch it covers in
both, so that gaps, inserted characters and other endings lower the likeness without removing it. A second kernel counts the
subsequence that is the whole landmark, weighed down by each of up to ``INSERTED`` characters between its own: it sees an insult
through inserted letters that break up all short subsequences. Runs of single characters are read as one word, and a word
with marks inside is also read without them. The kernel of two sentences adds up a power of the kernels of all pairs of their words.
Landmarks are words and stems that the labels point to; projected onto them, a sentence is a short vector, a sum over its
words, and the machine's margin a sum of one number per word. Each worker works that number
out once per new word. Sentences take their document's label at first; sentences of toxic documents that the machine
finds clean are then relabelled, but for the worst of each, and it is fitted again. A document's score is its worst
sentence's margin, and what the other sentences add, through a logistic function fitted to the training documents.

It learns from at most ``most`` labelled documents (a bound that does not grow), on the driver; every document is
scored where it lies. A word of more than ``STRETCH`` characters is read in stretches of that length that overlap by half,
and is as like a landmark as the stretch that is most like it, so that time and memory grow with its length alone.

Defined cases: a null or empty text has no sentence and scores as a clean sentence of no words. A null doc_id is never learnt from and its held_out is null. Repeated rows are scored each. If no label or only one kind
is known, every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import batch, read_table, texts_of
from churnkit.llm.registry import query
from churnkit.llm.training import labelled_sample, remainder

ORDER = 3
DECAY = 0.6
POWER = 4
LEAST = 0.6
INSERTED = 2
INSERT_DECAY = 0.9
STRETCH = 64
LANDMARKS = 32
START = "^"
_STEMS = (5, 6, 7, 8)
_EDGE = ".,;:!?\"'()[]{}*#$%&|<>_-~=+/\\`^@"
_ENDS = (".", "!", "?")
_MEMORY = 400_000
_BLOCK = 4096


def codes(words: list[str], pad: int) -> np.ndarray:
    """Character codes, one row per word, padded on the right."""
    sizes = np.array([len(w) for w in words], np.int64)
    out = np.full((len(words), int(sizes.max(initial=0))), pad, np.int32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.frombuffer("".join(words).encode("utf-32-le", "replace"), "<i4")
    return out


def kernel(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Gap-weighted subsequence kernel of pairs of rows of character codes; pads (-1, -2) match nothing.

    Row a of the result is the kernel of the first a + 1 characters of ``left`` with all of ``right``. One pass over the
    characters of ``left`` keeps, for each prefix of ``right``, the weight of partial subsequences that may go on.
    """
    return np.cumsum([e.sum(0) for e in _endings(left, right)], axis=0).reshape(-1, len(right))


def _endings(left: np.ndarray, right: np.ndarray) -> Iterator[np.ndarray]:
    """For each character of ``left``, the weight of subsequences that end there and at each character of ``right``."""
    n, size = right.shape
    square, decay = np.float32(DECAY * DECAY), np.float32(DECAY)
    partial = np.zeros((ORDER, size + 1, n), np.float32)
    partial[0] = 1
    for a in range(left.shape[1]):
        same = (left[:, a][None, :] == right.T).astype(np.float32) * square
        yield same * partial[ORDER - 1, :size]
        for i in range(ORDER - 1, 0, -1):
            gain = same * partial[i - 1, :size]
            for b in range(1, size):
                gain[b] += decay * gain[b - 1]
            partial[i, 1:] *= decay
            partial[i, 1:] += gain


def prefix_norms(rows: np.ndarray) -> np.ndarray:
    """Kernel with itself of the first a + 1 characters of each row, in row a of the result."""
    ends = _endings(rows, np.where(rows == -1, -2, rows))
    return np.cumsum([2 * e[:a].sum(0) + e[a] for a, e in enumerate(ends)], axis=0).reshape(-1, len(rows))


def self_kernel(words: list[str]) -> np.ndarray:
    return np.array([prefix_norms(codes([w], -1))[-1, 0] if w else 0 for w in words], np.float32)


def features(word: str) -> dict[tuple[str, ...], float]:
    """What the kernel is the product of: each subsequence's weights, summed up. For short words only."""
    out: dict[tuple[str, ...], float] = {}
    for at in combinations(range(len(word)), ORDER):
        key = tuple(word[i] for i in at)
        out[key] = out.get(key, 0.0) + DECAY ** (at[-1] - at[0] + 1)
    return out


@cache
def _needed(landmark: str) -> int:
    """How many different characters of the landmark a word must have to be ``LEAST`` like it.

    By Cauchy and Schwarz a word is no more like it than the share of its features that the shared characters can spell.
    """
    weights = {k: v * v for k, v in features(landmark).items()}
    letters = sorted(set(landmark))
    for m in range(len(letters) + 1):
        for some in combinations(letters, m):
            have = set(some)
            if sum(v for k, v in weights.items() if have.issuperset(k)) >= (LEAST - 1e-3) ** 2 * sum(weights.values()):
                return m
    return len(letters)


@cache
def _spelled(landmark: str) -> tuple[list[tuple[tuple[str, ...], float]], float]:
    """The landmark's features of most weight, squared, and the share the others may add; all as shares of their sum."""
    weights = {k: v * v for k, v in features(landmark).items()}
    total = sum(weights.values()) or 1.0
    heavy = sorted(((k, v / total) for k, v in weights.items() if v > 0.01 * total), key=lambda x: -x[1])
    return heavy, 1 - sum(v for _, v in heavy)


def _can_spell(block: np.ndarray, rows: np.ndarray, landmark: str) -> np.ndarray:
    """Those rows whose characters stand in an order that allows enough of the landmark's features."""
    own = block[rows]
    place = np.arange(own.shape[1], dtype=np.int16)
    first, last = {}, {}
    for c in set(landmark):
        same = own == ord(c)
        first[c] = np.where(same, place, np.int16(9999)).min(1, initial=9999)
        last[c] = np.where(same, place, np.int16(-1)).max(1, initial=-1)
    heavy, share = _spelled(landmark)
    bound = np.full(len(rows), share, np.float32)
    for (a, b, c), weight in heavy:
        bound += np.float32(weight) * ((first[a] < last[b]) & (first[b] < last[c]) & (first[a] + 1 < last[c]))
    return rows[bound >= (LEAST - 1e-3) ** 2]


def likeness(words: list[str], landmarks: list[str], own: np.ndarray) -> np.ndarray:
    """Normalised kernel of each landmark and the beginning of the word that is most like it, to the power of ``POWER``.

    ``own`` has the landmarks' kernels with themselves. Less than ``LEAST`` counts as nothing, and pairs that can't
    reach it, by the characters they share and the order of these, are skipped.
    """
    out = np.zeros((len(words), len(landmarks)), np.float32)
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for k in range(0, len(order), _BLOCK):
        rows = np.array(order[k : k + _BLOCK])
        block = codes([words[i] for i in rows], -1)
        has = {c: (block == ord(c)).any(1) for z in landmarks for c in z}
        least = _distinct(block.shape[1])[:, None]  # a beginning of a word is at least as like itself as this
        for j, z in enumerate(landmarks):
            some = np.flatnonzero(sum(has[c].astype(np.int8) for c in sorted(set(z))) >= _needed(z))
            some = _can_spell(block, some, z)
            if len(some):
                total = kernel(block[some], np.broadcast_to(codes([z], -2), (len(some), len(z))))
                near = (total / np.sqrt(np.maximum(least * own[j], 1e-9))).max(0) >= LEAST - 1e-3
                some, total = some[near], total[:, near]
            if len(some):
                # Longer beginnings are too much like themselves to be ``LEAST`` like the landmark.
                most = int((least * own[j] * (LEAST - 1e-3) ** 2 <= total.max() ** 2).sum())
                norms = prefix_norms(block[some, :most])
                like = (total[:most] / np.sqrt(np.maximum(norms * own[j], 1e-9))).max(0, initial=0)
                out[rows[some], j] = np.where(like >= LEAST, np.minimum(like, 1) ** POWER, 0)
    return out


def without_marks(word: str) -> str:
    """The word without punctuation, symbols and invisible characters behind its first character."""
    if word[1:].isalnum():
        return word
    return word[:1] + "".join(c for c in word[1:] if unicodedata.category(c)[0] not in "PSC")


def inserted_likeness(words: list[str], landmarks: list[str]) -> np.ndarray:
    """The kernel of each whole landmark: ``INSERT_DECAY`` to the power of the characters inserted into it, if few.

    A word holds the landmark from its first character on; taking each character as early as possible ends earliest.
    """
    out = np.zeros((len(words), len(landmarks)), np.float32)
    for k in range(0, len(words), _BLOCK):
        part = words[k : k + _BLOCK]
        for j, z in enumerate(landmarks):
            block = codes([w[: len(z) + INSERTED] for w in part], -1)
            place = np.arange(block.shape[1])
            at = np.full(len(part), -1)
            rows = np.arange(len(part))
            for c in z:  # only words that hold the landmark so far go on
                match = (block[rows] == ord(c)) & (place > at[rows, None])
                rows, match = rows[match.any(1)], match[match.any(1)]
                at[rows] = match.argmax(1)
            inserted = at[rows] + 1 - len(z)
            out[k + rows, j] = np.power(INSERT_DECAY, inserted)
    return out**POWER


def _whole_likeness(words: list[str], landmarks: list[str], own: np.ndarray) -> np.ndarray:
    """Likeness by either kernel, of words no longer than a stretch."""
    return np.maximum(likeness(words, landmarks, own), inserted_likeness(words, landmarks))


def stretches(word: str) -> list[str]:
    """The word, or if it is long its stretches, each beginning half a stretch behind the one before."""
    if len(word) <= STRETCH:
        return [word]
    return [word[i : i + STRETCH] for i in range(0, len(word) - STRETCH // 2, STRETCH // 2)]


def word_likeness(words: list[str], landmarks: list[str], own: np.ndarray) -> np.ndarray:
    """Likeness of each word, read as it is and without inner marks, at its stretch that is most like the landmark."""
    out = np.zeros((len(words), len(landmarks)), np.float32)
    readings: list[str] = []
    of: list[int] = []
    for i, w in enumerate(words):
        plain = without_marks(w)
        for reading in (w,) if plain == w else (w, plain):
            for part in stretches(reading):
                readings.append(part)
                of.append(i)
                if len(readings) == 1 << 15:  # one word may have any number of stretches
                    np.maximum.at(out, of, _whole_likeness(readings, landmarks, own))
                    readings, of = [], []
    if readings:
        np.maximum.at(out, of, _whole_likeness(readings, landmarks, own))
    return out


@cache
def _distinct(size: int) -> np.ndarray:
    """The kernel with themselves of 1, 2, .. ``size`` different characters; repeated ones only add to it."""
    return prefix_norms(np.arange(size, dtype=np.int32)[None, :])[:, 0] if size else np.empty(0, np.float32)


def units(raw: Iterable[str]) -> list[str]:
    """Words in lower case without marks at their ends, behind a mark for the start of a word.

    Three or more single characters in a row are one word.
    """
    out: list[str] = []
    single: list[str] = []
    for r in raw:
        w = r.strip(_EDGE).lower()
        if len(w) == 1:
            single.append(w)
            continue
        if single:
            out += ["".join(single)] if len(single) >= 3 else single
            single = []
        if w:
            out.append(w)
    out += ["".join(single)] if len(single) >= 3 else single
    return [START + w for w in out]


def sentences(text: str) -> list[list[str]]:
    """Units of each sentence. A line end, or a word that ends in . ! or ?, ends a sentence of three words or more."""
    out, now = [], []
    for line in text.split("\n"):
        for w in line.split():
            now.append(w)
            if w.endswith(_ENDS) and len(now) > 2:
                out.append(units(now))
                now = []
        if now:
            out.append(units(now))
            now = []
    return [s for s in out if s]


@dataclass
class Machine:
    """``weights`` on the likeness to each landmark, ``bias``, and a logistic function of the worst margins."""

    landmarks: list[str]
    own: np.ndarray
    weights: np.ndarray
    bias: float
    slopes: tuple[float, float]
    shift: float

    def values(self, words: list[str]) -> np.ndarray:
        """What each word adds to its sentence's margin."""
        if not self.landmarks:
            return np.zeros(len(words))
        return word_likeness(words, self.landmarks, self.own) @ self.weights

    def score(self, worst: float, rest: float) -> float:
        a, b = self.slopes
        return 1 / (1 + math.exp(-min(max(a * worst + b * rest + self.shift, -30), 30)))


def worst_margins(margins: Iterable[float], bias: float) -> tuple[float, float]:
    """A document's largest margin, and how far all others rise above that of a sentence of no words, at most 5."""
    above = sorted((max(m - bias, 0.0) for m in margins), reverse=True)
    return (above[0] if above else 0.0) + bias, min(sum(above[1:]), 5.0)


class Scorer:
    """A machine with the values of the words met so far."""

    def __init__(self, machine: Machine):
        self.machine = machine
        self.known: dict[str, float] = {}

    def scores(self, texts: list[str]) -> list[float]:
        split = [sentences(t) for t in texts]
        if len(self.known) > _MEMORY:
            self.known.clear()
        fresh = sorted({w for doc in split for s in doc for w in s} - self.known.keys())
        for i in range(0, len(fresh), 1 << 15):
            part = fresh[i : i + (1 << 15)]
            self.known.update(zip(part, self.machine.values(part).tolist()))
        value, bias = self.known.__getitem__, self.machine.bias
        margins = ([sum(map(value, s)) + bias for s in doc] for doc in split)
        out = [self.machine.score(*worst_margins(m, bias)) for m in margins]
        for w in fresh:
            if len(w) > STRETCH:  # what is remembered is bounded in length as well
                del self.known[w]
        return out


def choose_landmarks(docs: list[set[str]], labels: np.ndarray, most: int = LANDMARKS) -> list[str]:
    """Words and stems of words that toxic documents have far more often than others.

    One at a time: the one that speaks for most toxic documents with fewer than two so far; of equals the longest. It
    ends when the next would add less than 2 % of them and is not in a tenth of all. No two begin alike.
    """

    def stems(words: set[str]) -> set[str]:
        return {w[:n] for w in words for n in _STEMS if len(w) >= n} | {w for w in words if ORDER < len(w) <= 12}

    holders: dict[str, set[int]] = {}
    for i, (d, y) in enumerate(zip(docs, labels)):
        if y:
            for w in stems(d):
                holders.setdefault(w, set()).add(i)
    least = max(3, 0.02 * labels.sum())
    holders = {w: h for w, h in holders.items() if len(h) >= least}
    clean: Counter = Counter()
    for d, y in zip(docs, labels):
        if not y:
            clean.update(stems(d) & holders.keys())
    n_toxic, n_clean = max(1, int((labels > 0).sum())), max(1, int((labels == 0).sum()))

    def odds(w: str, n: int) -> float:
        return math.log(((n + 0.5) / n_toxic) / ((clean[w] + 0.5) / n_clean))

    weight = {w: odds(w, len(h)) for w, h in holders.items()}
    holders = {w: h for w, h in holders.items() if weight[w] > 3}
    chosen: list[str] = []
    times: Counter = Counter()
    widely = {w for w, h in holders.items() if len(h) >= 0.1 * n_toxic}
    while len(chosen) < most:
        left = {w: {i for i in h if times[i] < 2} for w, h in holders.items()}
        holders = {w: h for w, h in left.items() if len(h) >= least or w in widely}
        if not holders:
            break
        best = max(holders, key=lambda w: (round(len(holders[w]) * weight[w], 6), len(w), w))
        chosen.append(best)
        times.update(holders[best])
        holders = {w: h for w, h in holders.items() if not w.startswith(best[: _STEMS[0]])}
    return chosen


def support_vectors(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by Newton steps on the rows inside the margin; y is -1 or 1."""
    z = np.hstack([x, np.ones((len(x), 1))])
    penalty = ridge * np.eye(z.shape[1])
    penalty[-1, -1] = 1e-8
    w = np.zeros(z.shape[1])
    weight = weight / weight.sum()
    inside = np.ones(len(z), bool)
    for _ in range(30):
        part = z[inside] * weight[inside][:, None]
        w = np.linalg.solve(part.T @ z[inside] + penalty, part.T @ y[inside])
        now = y * (z @ w) < 1
        if (now == inside).all():
            break
        inside = now
    return w[:-1], float(w[-1])


def logistic_plane(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slopes (never below 0) and shift of a logistic regression, lightly held back so that it stays finite.

    Both labels weigh the same in all, however rare one of them is.
    """
    z = np.hstack([x, np.ones((len(x), 1))])
    share = y.mean()
    weight = np.where(y > 0, (1 - share) / share, 1.0)
    held = np.array([1e-2] * x.shape[1] + [1e-4])
    w = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(held)
        step = np.linalg.solve(hessian, z.T @ (weight * (y - p)) - held * w)
        w = w + np.clip(step, -2, 2)
        w[:-1] = np.maximum(w[:-1], 0)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(texts: list[str], labels: np.ndarray, rounds: int = 4) -> Machine:
    """The machine for documents (in a fixed order) and their 0/1 labels."""
    share = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or not 0 < share < 1:
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Machine([], np.empty(0), np.empty(0), 0.0, (0.0, 0.0), math.log(share / (1 - share)))
    split = [sentences(t) for t in texts]
    landmarks = choose_landmarks([{w for s in d for w in s} for d in split], labels)
    if not landmarks:
        return Machine([], np.empty(0), np.empty(0), 0.0, (0.0, 0.0), math.log(share / (1 - share)))
    own = self_kernel(landmarks)
    gram = likeness(landmarks, landmarks, own).astype(np.float64)
    values, axes = np.linalg.eigh(gram)
    keep = values > 1e-4 * values.max()
    project = axes[:, keep] / np.sqrt(values[keep])  # the Nyström map
    words = sorted({w for d in split for s in d for w in s})
    number = {w: i for i, w in enumerate(words)}
    like = word_likeness(words, landmarks, own)
    doc = np.array([i for i, d in enumerate(split) for _ in d])
    sums = np.array([like[[number[w] for w in s]].sum(0) for d in split for s in d]).reshape(-1, len(landmarks))
    x = sums.astype(np.float64) @ project
    truth = labels[doc] > 0
    y = truth.copy()
    for _ in range(rounds):
        weight = np.where(y, 0.5 / max(1, y.sum()), 0.5 / max(1, (~y).sum()))
        w, bias = support_vectors(x, np.where(y, 1.0, -1.0), weight)
        margin = x @ w + bias
        worst = np.full(len(split), -np.inf)
        np.maximum.at(worst, doc, margin)
        y = truth & ((margin > 0) | (margin >= worst[doc]))
    margins: list[list[float]] = [[] for _ in split]
    for i, m in zip(doc.tolist(), margin.tolist()):
        margins[i].append(m)
    a, b, shift = logistic_plane(np.array([worst_margins(m, bias) for m in margins]), labels).tolist()
    return Machine(landmarks, own, (project @ w).astype(np.float32), bias, (a, b), shift)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, held: int = 1, most: int = 3000
) -> DataFrame:
    """doc_id, held_out and score (0 to 1, higher: label 1 likelier) of every document.

    Learns from at most ``most`` labelled documents whose id's remainder by ``folds`` is not ``held``.
    """
    allowed = remainder(F.col("doc_id"), folds) != held
    sample = labelled_sample(docs.select("doc_id", "text"), labels, label, allowed, most)
    rows = sample.select("text", "label").orderBy("doc_id", "text").collect()
    machine = fit([r.text or "" for r in rows], np.array([r.label for r in rows], float))
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(machine)
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                yield batch(schema, part.column("doc_id"), scorer.scores(texts_of(part.column("text"))))

    scored = docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", (remainder(F.col("doc_id"), folds) == held).alias("held_out"), "score")


@query()
def op9_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    scored = score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
