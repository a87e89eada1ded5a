"""Documents rejected by fixed limits or as outliers of their language and source.

Each text becomes a few counts, and these a vector of transformed statistics. For every language and source a minimum
covariance determinant estimate is fitted to the documents that pass the fixed limits: from medians and absolute
deviations it starts, and each concentration step takes the share ``core`` of documents nearest to the centre and
computes their mean and covariance anew. A document goes when its squared Mahalanobis distance exceeds ``cutoff``, the
chi-square quantile that one of ``1 / _TAIL`` normal documents exceeds.
The least standard deviations ``_FLOOR`` are added, so that a statistic that hardly varies in a group can't reject
documents for a trifle.

A concentration step is one aggregate: distances fall into bins, and each group and bin keeps its count, sums
and products, as whole numbers, so that no order of addition changes them. The bins nearest to the centre that hold the
core are added up. A group of fewer than ``GROUP_ROWS`` documents within the limits is judged by its whole language,
large sources included, and if that has too few, by all documents, however few these are: so every document has a
distance if any is within the limits. In a model of fewer than ``GROUP_ROWS`` documents the least deviations are widened.
A caller who gives ``min_rows`` has no model fitted to fewer; what would need one has no distance and is not rejected.

Defined cases: a null or empty text has no words and fails the limits. Null languages and sources are groups like any
other; if a column is missing, all rows count as null in it. Repeated rows count each. ``filter_quality`` judges each row by
its own text, language and source, also if its doc_id repeats or is null. Extra columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import Workspace, batch, by_text, read_table, texts_of
from churnkit.llm.registry import query
from churnkit.llm.words import covered, mix, split_words

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks")
_VECTOR = ("length", "symbols", "dup_lines", "repeats", "upper", "marks")
# Least standard deviations of the transformed statistics.
_FLOOR = (0.08, 0.12, 0.35, 0.10, 0.08, 0.12)
_TAIL = 1e-4
GROUP_ROWS = 200
_SMALL = 1_000_000
_WIDER = 20  # least variances grow by so many times 1 / n in a model of n documents
_ALL = "all"
_UNITS = 1000  # statistics are whole numbers of thousandths
_BINS_PER_DOUBLING = 8

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_MARKS = np.zeros(256, bool)
_MARKS[list(b"!?;:/\\=+^~_@()[]{}\"`")] = True
_BLANKS = " \t\n\x0b\x0c\r"


def _dup_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(_BLANKS)]
    return len(lines) - len(set(lines))


def counts_of(texts: list[str], repeat_window: int = 8) -> list[np.ndarray]:
    """The counts named in ``_COUNTS`` for each text."""
    words = split_words([t.encode() for t in texts])
    in_word = ~((words.data == 32) | ((words.data >= 9) & (words.data <= 13)))
    whole = (words.data & 0xC0) != 0x80  # first byte of a code point
    hashes, at = words.windows(repeat_window)
    own = mix(hashes ^ mix(words.doc[at].astype(np.uint64)))
    order = np.argsort(own, kind="stable")
    same = own[order][1:] == own[order][:-1]
    twice = np.zeros(len(own), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    repeated = covered(at[twice], repeat_window, len(words.start))
    return [
        np.diff(words.first),
        words.bytes_per_doc(in_word & whole),
        words.bytes_per_doc(_SYMBOLS[words.data]),
        np.array([_dup_lines(t) for t in texts], np.int64),
        words.words_per_doc(repeated),
        words.bytes_per_doc(_UPPER[words.data]),
        words.bytes_per_doc(_MARKS[words.data]),
    ]


def _given(docs: DataFrame, name: str) -> Column:
    return (docs[name] if name in docs.columns else F.lit(None)).cast("string")


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the text, lang, source, the counts, base_failed and the vector of every document."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("digest", pa.int64()), ("lang", pa.string()), ("source", pa.string())]
        + [(c, pa.int64()) for c in _COUNTS]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in by_text(b, "text", 1 << 20):
                own = b.slice(part.start, part.stop - part.start)
                found = counts_of(texts_of(own.column("text")))
                yield batch(schema, *[own.column(c) for c in ("doc_id", "digest", "lang", "source")], *found)

    types = "doc_id long, digest long, lang string, source string, " + ", ".join(f"{c} long" for c in _COUNTS)
    read = [_given(docs, c).alias(c) for c in ("lang", "source")]
    rows = docs.select("doc_id", F.xxhash64("text").alias("digest"), *read, "text").mapInArrow(count, types)
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    vector = {
        "length": F.log(F.greatest(F.col("word_chars") / words, F.lit(0.1))),
        "symbols": F.sqrt(F.col("n_symbols") / words),
        "dup_lines": F.log1p(F.col("n_dup_lines").cast("double")),
        "repeats": F.sqrt(F.col("n_repeat_words") / words),
        "upper": F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)).cast("double"),
        "marks": F.sqrt(F.col("n_marks") / words),
    }
    failed = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return rows.withColumn("base_failed", failed).withColumns(
        {n: F.round(c * _UNITS).cast("long") for n, c in vector.items()}
    )


def _grouped(rows: DataFrame, min_rows: int) -> DataFrame:
    """Adds ``grp``, the group whose model judges the row: language and source, or the language, or all documents.

    ``counts_in`` has the groups whose models the row helps to fit: its own, and the wider ones that judge some row.
    """
    sizes = rows.groupBy("lang", "source").agg(F.count_if(~F.col("base_failed")).alias("n"))
    langs = sizes.groupBy("lang").agg(F.sum("n").alias("n_lang"), F.min("n").alias("least"))
    some = not langs.where(F.col("n_lang") < min_rows).isEmpty()
    large, enough = F.col("n") >= min_rows, F.col("n_lang") >= min_rows
    own = F.when(large, F.to_json(F.struct("s.lang", "s.source")))
    lang = F.when(enough, F.to_json(F.struct("s.lang")))
    wider = [F.when(F.col("least") < min_rows, lang), F.lit(_ALL if some else None).cast("string")]
    named = sizes.alias("s").join(langs.alias("l"), F.expr("s.lang <=> l.lang")).select(
        F.col("s.lang").alias("l"),
        F.col("s.source").alias("s"),
        F.coalesce(own, lang, F.lit(_ALL)).alias("grp"),
        F.array_compact(F.array(own, *wider)).alias("counts_in"),
    )
    return rows.join(named, F.expr("lang <=> l and source <=> s")).drop("l", "s")


def _distance(vector: list[Column]) -> Column:
    """Squared Mahalanobis distance with the ``centre`` and ``precision`` of the row's group."""
    d = len(vector)
    away = [x / F.lit(float(_UNITS)) - F.col("centre")[i] for i, x in enumerate(vector)]
    terms = [
        F.col("precision")[i * d + j] * away[i] * away[j] * F.lit(1.0 if i == j else 2.0)
        for i in range(d)
        for j in range(i, d)
    ]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.greatest(total, F.lit(0.0))


_MODEL = "grp string, n long, centre array<double>, precision array<double>"


def _model(n: int, centre: np.ndarray, scatter: np.ndarray) -> dict:
    wider = 1 + _WIDER * max(0.0, 1 / max(n, 1) - 1 / GROUP_ROWS)
    precision = np.linalg.inv(scatter + wider * np.diag(np.square(_FLOOR)))
    return {"centre": centre.tolist(), "precision": precision.ravel().tolist()}


def _start(rows: DataFrame) -> DataFrame:
    """Medians and absolute deviations, one statistic at a time."""
    median = [F.percentile_approx(c, 0.5, 10_000).alias(f"m_{c}") for c in _VECTOR]
    # Written, so that its size is known and it can be broadcast: all documents may be one group.
    medians = Workspace(rows.sparkSession).write(rows.groupBy("grp").agg(F.count("*").alias("n"), *median))
    away = [F.percentile_approx(F.abs(F.col(c) - F.col(f"m_{c}")), 0.5, 10_000).alias(f"d_{c}") for c in _VECTOR]
    spread = rows.join(medians, "grp").groupBy("grp").agg(*away)

    def model(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.to_dict("records"):
                centre = np.array([r[f"m_{c}"] for c in _VECTOR]) / _UNITS
                wide = 1.4826 * np.array([r[f"d_{c}"] for c in _VECTOR]) / _UNITS
                out.append({"grp": r["grp"], "n": r["n"], **_model(r["n"], centre, np.diag(wide**2))})
            yield pd.DataFrame(out, columns=["grp", "n", "centre", "precision"])

    return medians.join(spread, "grp").mapInPandas(model, _MODEL)


def _consistency(core: float, d: int) -> float:
    """By how much the covariance of the nearest ``core`` of a normal sample falls short (Wilson and Hilferty's cubes)."""
    cut = d * (1 - 2 / (9 * d) + NormalDist().inv_cdf(core) * (2 / (9 * d)) ** 0.5) ** 3
    e = d + 2
    inside = NormalDist().cdf(((cut / e) ** (1 / 3) - (1 - 2 / (9 * e))) / (2 / (9 * e)) ** 0.5)
    return core / inside


def _concentrate(rows: DataFrame, models: DataFrame, core: float) -> DataFrame:
    """One step: mean and covariance of the documents in the bins of distance that hold the core."""
    d = len(_VECTOR)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    away = rows.join(models.select("grp", "centre", "precision"), "grp").withColumn(
        "bin", F.floor(F.log2(_distance([F.col(c) for c in _VECTOR]) + 0.01) * _BINS_PER_DOUBLING).cast("int")
    )
    sums = [F.sum(c).alias(f"s{i}") for i, c in enumerate(_VECTOR)]
    products = [F.sum(F.col(_VECTOR[i]) * F.col(_VECTOR[j])).alias(f"p{i}_{j}") for i, j in pairs]
    binned = away.groupBy("grp", "bin").agg(F.count("*").alias("n"), *sums, *products)
    wider = _consistency(core, d)

    def step(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("bin", ignore_index=True)
        total = int(f["n"].sum())
        seen = f["n"].cumsum()
        inside = f[(seen - f["n"]) < core * total]
        n = int(inside["n"].sum())
        s = np.array([float(inside[f"s{i}"].sum()) for i in range(d)]) / _UNITS
        scatter = np.zeros((d, d))
        for i, j in pairs:
            p = float(inside[f"p{i}_{j}"].sum()) / _UNITS**2
            scatter[i, j] = scatter[j, i] = (p - s[i] * s[j] / n) / max(n - 1, 1)
        return pd.DataFrame([{"grp": f["grp"][0], "n": total, **_model(total, s / n, scatter * wider)}])

    return binned.groupBy("grp").applyInPandas(step, _MODEL)


def chi_square_cutoff(tail: float, d: int) -> float:
    """What the squared distance of a normal vector of ``d`` statistics, an even number, exceeds with probability ``tail``."""
    low, high = 0.0, 1000.0
    for _ in range(60):
        x = (low + high) / 2
        beyond = math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(d // 2))
        low, high = (x, high) if beyond > tail else (low, x)
    return high


def judge(
    docs: DataFrame, core: float = 0.75, cutoff: float | None = None, steps: int = 4, min_rows: int | None = None
) -> DataFrame:
    """doc_id, digest, lang, source, counts, base_failed, distance (squared; null without a model) and kept of every row.

    ``cutoff`` is the chi-square quantile if it is not given, ``min_rows`` is ``GROUP_ROWS`` for narrow groups and 1 for all.
    """
    if cutoff is None:
        cutoff = chi_square_cutoff(_TAIL, len(_VECTOR))
    ws = Workspace(docs.sparkSession)
    rows = ws.write(statistics(docs))
    ready = ws.write(_grouped(rows, GROUP_ROWS if min_rows is None else min_rows))
    ws.drop(rows)
    good = ready.where(~F.col("base_failed")).select(F.explode("counts_in").alias("grp"), *_VECTOR)
    models = ws.write(_start(good).where(F.col("n") >= (min_rows or 1)))
    for _ in range(steps):
        models, old = ws.write(_concentrate(good, models, core)), models
        ws.drop(old)
    judged = ready.join(models.select("grp", "centre", "precision"), "grp", "left")
    distance = F.when(F.col("centre").isNotNull(), _distance([F.col(c) for c in _VECTOR]))
    judged = judged.withColumn("distance", distance)
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)
    return judged.select("doc_id", "digest", "lang", "source", *_COUNTS, "base_failed", "distance", kept.alias("kept"))


def filter_quality(docs: DataFrame, **options) -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns.

    What a verdict depends on, and the id, make two numbers of a rejected row: up to ``_SMALL`` rows, 16 MB, are broadcast,
    so that no text is shuffled; more are merged.
    """
    ws = Workspace(docs.sparkSession)
    judged = judge(docs, **options).where(~F.col("kept"))
    rejected = judged.select("doc_id", _verdict_key(F.col("digest"), F.col("lang"), F.col("source")).alias("verdict_key"))
    rejected = ws.write(rejected.distinct())
    rejected = F.broadcast(rejected) if rejected.count() <= _SMALL else rejected.hint("merge")
    own = _verdict_key(F.xxhash64(docs["text"]), _given(docs, "lang"), _given(docs, "source"))
    same = docs["doc_id"].eqNullSafe(rejected["doc_id"]) & (own == rejected["verdict_key"])
    return docs.join(rejected, same, "left_anti")


def _verdict_key(digest: Column, lang: Column, source: Column) -> Column:
    """A number for all that a verdict depends on; a hash passes over nulls, so these are told apart by flags."""
    return F.xxhash64(digest, lang, source, lang.isNull(), source.isNull())


@query()
def op7_quality_rules(spark, sf_dir):
    """Counts, limits and verdict of every document."""
    done = judge(read_table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )
