"""Spelling variants: words that one edit turns into each other, found through Gram matrices of letter counts.

A word is a vector of how often it has each letter. A replaced letter moves two words apart by a squared distance of exactly 2,
an inserted or deleted one by exactly 1; so near words are pairs at most two apart whose lengths are equal or adjacent,
and only those are compared letter by letter. All squared distances of a block come from one NumPy product:
|x|^2 + |y|^2 - 2 x.y.

Blocks are small without losing a pair. Letters fall into ``SPLIT`` sets; an edit changes the counts of two letters at most,
so at least SPLIT - 2 sets keep theirs. For each choice of SPLIT - 2 sets there is a block for
every value of their counts and every length: it holds the words of that length and, as partners only, those one longer.
A pair is reported by the first choice that both words agree in, hence once. A block of more than ``TILE`` words is cut into
tiles by a hash of the word, and every pair of tiles is a cell of its own, so that a block that holds a third of all
words is compared in many tasks. Cells are dealt to buckets that hold about ``BUCKET`` rows each.

Each word's most frequent near word is its form if it is ten times as frequent. Counts grow along forms, so forms have
no cycles and are followed by pointer doubling in a few joins.

Defined cases: a null text has no words, a null doc_id reads as the empty string in ``<doc_id>:<run>``. Repeated rows
count each. Extra columns are ignored. Without words there are no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import Workspace, batch, parts_for, read_table
from churnkit.llm.registry import query
from churnkit.llm.words import mix

SPLIT = 4
TILE = 20_000
BUCKET = 60_000
_ROWS = 512
_COLUMNS = 8192
_SMALL = 1_000_000
_HELD = 300_000
_U = np.uint64
_LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_NUMBER = np.full(256, -1, np.int64)
_NUMBER[_LETTERS] = np.arange(len(_LETTERS))
_CHOICES = list(combinations(range(SPLIT), SPLIT - 2))


def misread(doc_id: int | None, run: str, modulus: int) -> str:
    """The run without one of its code points, if ``modulus`` divides the hash of id and run."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % modulus:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, min_chars: int = 7, min_count: int = 2, modulus: int = 31) -> DataFrame:
    """word and n of the words of all texts; summed up inside each task before the shuffle."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    runs = re.compile("[A-Za-zÀ-ÿ]{%d,}" % min_chars)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            for doc_id, raw in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                if not raw:
                    continue
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                # Only a hash of run and document together decides, so equal runs of a document are read once.
                for run, n in Counter(runs.findall(raw.translate(_LOWER).decode())).items():
                    if zlib.crc32(run.encode(), start) % modulus == 0:
                        run = misread(doc_id, run, modulus)
                        if len(run) < min_chars:
                            continue
                    held[run] += n
                if len(held) > _HELD:
                    yield batch(schema, list(held), list(held.values()))
                    held = Counter()
        yield batch(schema, list(held), list(held.values()))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    counted = rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


class Vectors:
    """Code points and letter counts of some words, one after another."""

    def __init__(self, words: list[str]):
        self.size = np.array([len(w) for w in words], np.int64)
        self.points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.letters = _NUMBER[self.points]

    def counts(self) -> np.ndarray:
        """One row per word, one column per letter; whole numbers that the type holds exactly, squares and sums included."""
        row = np.repeat(np.arange(len(self.size)), self.size)
        flat = np.bincount(row * len(_LETTERS) + self.letters, minlength=len(self.size) * len(_LETTERS))
        exact = np.float32 if int(self.size.max(initial=0)) <= 2000 else np.float64
        return flat.reshape(-1, len(_LETTERS)).astype(exact)

    def signatures(self) -> np.ndarray:
        """For each choice of letter sets a number that stands for the word's counts of their letters."""
        number = mix(np.arange(1, len(_LETTERS) + 1, dtype=_U))
        each = np.arange(len(_LETTERS)) % SPLIT
        out = np.empty((len(_CHOICES), len(self.size)), _U)
        for c, choice in enumerate(_CHOICES):
            value = np.where(np.isin(each, choice), number, _U(0))[self.letters]
            out[c] = mix(np.add.reduceat(value, self.start)) if len(value) else 0
        return out

    def one_edit(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words a[i] and b[i], the second as long or one longer, differ by one code point."""
        out = np.zeros(len(a), bool)
        for size in np.unique(self.size[a]).tolist():
            some = np.flatnonzero(self.size[a] == size)
            step = max(1, (1 << 20) // size)
            for part in (some[i : i + step] for i in range(0, len(some), step)):
                left = self.points[self.start[a[part], None] + np.arange(size)]
                longer = self.size[b[part]] > size
                begin = self.points[self.start[b[part], None] + np.arange(size)]
                # The longer word read from its second code point; of words as long it is the word itself.
                end = self.points[(self.start[b[part]] + longer)[:, None] + np.arange(size)]
                same = np.cumprod(left == begin, axis=1).sum(1) + np.cumprod((left == end)[:, ::-1], axis=1).sum(1)
                out[part] = np.where(longer, same >= size, same >= size - 1)
        return out


def _blocks(words: DataFrame) -> DataFrame:
    """choice, block, longer, word and n: each word in its own blocks and in those where it is a partner of shorter words."""
    schema = pa.schema([("choice", pa.int32()), ("block", pa.int64()), ("longer", pa.bool_()), ("word", pa.string()), ("n", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 4096):
                b = whole.slice(i, 4096)
                v = Vectors(b.column("word").to_pylist())
                m = b.num_rows
                for c, signature in enumerate(v.signatures()):
                    for longer in (False, True):
                        with np.errstate(over="ignore"):
                            size = (v.size - longer).astype(_U) * _U(len(_CHOICES)) + _U(c)
                            block = mix(signature + size * _U(0x9E3779B97F4A7C15))
                        yield batch(schema, [c] * m, block.view(np.int64), [longer] * m, b.column("word"), b.column("n"))

    return words.mapInArrow(place, "choice int, block long, longer boolean, word string, n long")


def _cells(placed: DataFrame, tile: int) -> DataFrame:
    """Adds first, second, row and column: the cells in which a word is compared, and on which side.

    A block of one tile is one cell. Of more, a word of tile t is a row in the cells (t, u) of all u, and a column in (t, t)
    and in (s, t) of all s below t; a longer word is a column in (s, t) of all s.
    """
    sizes = placed.groupBy("block").agg(F.count("*").alias("size")).where(F.col("size") > tile)
    large = sizes.select("block", F.ceil(F.col("size") / tile).cast("int").alias("tiles"))
    few = F.broadcast(large) if large.count() <= _SMALL else large.hint("merge")
    placed = placed.join(few, "block", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))

    def cell(first: Column, second: Column, row: Column, column: Column) -> Column:
        return F.struct(first.alias("first"), second.alias("second"), row.alias("row"), column.alias("column"))

    yes, no, own = F.lit(True), F.lit(False), F.col("own")
    every = F.sequence(F.lit(0), F.col("tiles") - 1)
    as_row = F.transform(every, lambda u: cell(own, u, yes, u == own))
    as_column = F.transform(F.filter(every, lambda s: s < own), lambda s: cell(s, own, no, yes))
    as_longer = F.transform(every, lambda s: cell(s, own, no, yes))
    cells = F.when(F.col("longer"), as_longer).otherwise(F.concat(as_row, as_column))
    return placed.select("choice", "block", "longer", "word", "n", F.inline(cells))


def near_pairs(
    words: list[str], cell: np.ndarray, choice: np.ndarray, row: np.ndarray, column: np.ndarray, longer: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places of near words that are a row and a column of one cell, each pair once; equal cells stand together."""
    v = Vectors(words)
    x = v.counts()
    x = x[:, x.any(axis=0)]
    norm = (x * x).sum(axis=1)
    signatures = v.signatures()
    away = np.where(longer, 1, 2).astype(x.dtype)
    edges = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]])
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    begin = 0
    while begin < len(edges) - 1:
        end = begin + 1  # small cells share a product; pairs across cells are struck out
        while end < len(edges) - 1 and edges[end + 1] - edges[begin] <= _ROWS:
            end += 1
        low, high = int(edges[begin]), int(edges[end])
        rows, columns = (low + np.flatnonzero(side[low:high]) for side in (row, column))
        for i in range(0, len(rows), _ROWS):
            own = rows[i : i + _ROWS]
            for j in range(0, len(columns), _COLUMNS):
                other = columns[j : j + _COLUMNS]
                apart = norm[own][:, None] + norm[other] - 2 * (x[own] @ x[other].T)
                a, b = np.nonzero(apart == away[other])
                a, b = own[a], other[b]
                # Two words that are both rows meet twice; the first choice that they agree in reports a pair.
                keep = (cell[a] == cell[b]) & ((a < b) | ~row[b])
                a, b = a[keep], b[keep]
                keep = (signatures[:, a] == signatures[:, b]).argmax(axis=0) == choice[a]
                a, b = a[keep], b[keep]
                keep = v.one_edit(a, b)
                found.append((a[keep], b[keep]))
        begin = end
    return tuple(np.concatenate(side) for side in zip(*found))


def near_words(words: DataFrame, tile: int = TILE, bucket: int = BUCKET) -> DataFrame:
    """word, other and k, the other's count: both directions of every pair of near words of (word, n)."""
    buckets = parts_for(words.count() * 2 * len(_CHOICES), bucket)
    cells = _cells(_blocks(words), tile)
    dealt = cells.withColumn("bucket", F.pmod(F.xxhash64("block", "first", "second"), F.lit(buckets)))
    schema = pa.schema([("word", pa.string()), ("other", pa.string()), ("k", pa.int64())])

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        block, first, second = (rows.column(c).to_numpy() for c in ("block", "first", "second"))
        order = np.lexsort((second, first, block))
        rows, block, first, second = rows.take(order), block[order], first[order], second[order]
        same = (block[1:] == block[:-1]) & (first[1:] == first[:-1]) & (second[1:] == second[:-1])
        cell = np.concatenate([[0], np.cumsum(~same)])
        names, counts = rows.column("word"), rows.column("n")
        sides = (rows.column(c).to_numpy() for c in ("choice", "row", "column", "longer"))
        a, b = near_pairs(names.to_pylist(), cell, *sides)
        left, right = np.concatenate([a, b]), np.concatenate([b, a])
        out = [names.take(left), names.take(right), counts.take(right)]
        return pa.Table.from_arrays([c.combine_chunks() for c in out], schema=schema)

    return dealt.groupBy("bucket").applyInArrow(compare, "word string, other string, k long")


def followed(ws: Workspace, forms: DataFrame) -> DataFrame:
    """word and root: where (word, form) leads in the end. Each round doubles the length of the ways; there are no cycles."""
    now = ws.write(forms.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("via"), F.col("root").alias("further"))
        after = ws.write(now.join(on.hint("merge"), F.col("root") == F.col("via"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
        ))
        ws.drop(now)
        if after.where("moved").isEmpty():
            return after.select("word", "root")
        now = ws.write(after.select("word", "root"))
        ws.drop(after)


def group_variants(
    docs: DataFrame, min_chars: int = 7, min_count: int = 2, modulus: int = 31, times: int = 10, tile: int = TILE, bucket: int = BUCKET
) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of ``min_chars`` code points that occurs ``min_count`` times."""
    ws = Workspace(docs.sparkSession)
    words = ws.write(word_counts(docs, min_chars, min_count, modulus))
    best = F.min(F.struct((-F.col("k")).alias("less"), "other")).alias("best")
    near = near_words(words, tile, bucket).groupBy("word").agg(F.count("*").alias("n_near"), best)
    whole = words.join(near.hint("merge"), "word", "left")
    is_form = -F.col("best.less") >= F.lit(times) * F.col("n")
    whole = ws.write(whole.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best.other")).alias("form"),
        F.when(is_form, -F.col("best.less")).alias("form_n"),
    ))
    roots = followed(ws, whole.where("form is not null"))
    done = whole.join(roots.hint("merge"), "word", "left")
    return done.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


@query()
def op12_spelling_variants(spark, sf_dir):
    """Words of all documents, the form that each may be a misspelling of, and where forms lead."""
    return group_variants(read_table(spark, sf_dir, "documents"))
