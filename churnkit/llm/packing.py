"""Documents packed into fixed-length training sequences by repeating patterns of a few lengths.

Texts are tokenised once; what is kept of a piece is its length, so the work that looks at all pieces together sees
nothing but a histogram with one count per length, at most ``capacity`` of them however many documents there are.
Patterns of two to four lengths that fill a sequence exactly are listed from it, their repeat counts are fitted to the
histogram by non-negative least squares, rounded down, and what they leave is packed by best fit, longest first, equal
bins handled together. The outcome is a table that says, for the r-th piece of a length, which sequence and which offset
it gets. Pieces get their r in parallel: their rank in the task that tokenised them plus the counts of earlier tasks.

Defined cases: a null text is an empty one and gives one piece that holds the end token alone. A row with a null
doc_id is packed like any other. A text that spells the name of one of the tokenizer's added tokens has that token's id there.
Repeated rows are packed as often as they occur. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnkit.llm.common import Workspace, batch, read_table, texts_of
from churnkit.llm.registry import query

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, place long"


@cache
def encoder(ranks_path: str = RANKS, json_path: str = TOKENIZER) -> Callable[[str], list[int]]:
    """The ids that ``tokenizers`` gives with the JSON file and ``add_special_tokens=False``.

    A text without an added token's name goes through tiktoken with the ranks of the same vocabulary, several times
    faster; a text with one, which becomes a single id there, goes through ``tokenizers`` itself.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    fast = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    whole = Tokenizer.from_file(json_path)
    added = [t.content for t in whole.get_added_tokens_decoder().values()]

    def encode(text: str) -> list[int]:
        if any(name in text for name in added):
            return whole.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; of a document that is too long only the first is short."""
    if length <= capacity:
        return [(0, length)]
    head = length % capacity
    starts = range(head, length, capacity)
    return [(0, head)] * (head > 0) + [(s, capacity) for s in starts]


def tokenised_pieces(docs: DataFrame, capacity: int, end_id: int, ranks_path: str, json_path: str) -> DataFrame:
    """One row per piece. ``place`` counts the earlier pieces of the same length in the same ``task``."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32())]
        + [(n, pa.int64()) for n in ("start", "length", "ids_crc32", "task", "place")]
    )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_path, json_path)
        task = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), texts_of(b.column("text"))):
                ids = np.array([*encode(text), end_id], "<u4")
                for i, (start, length) in enumerate(cut(len(ids), capacity)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    rows.append((doc_id, i, start, length, crc, task, seen[length]))
                    seen[length] += 1
            if rows:
                yield batch(schema, *map(list, zip(*rows)))

    return docs.select("doc_id", "text").mapInArrow(pieces, _PIECES)


def patterns_of(counts: np.ndarray, per_length: int = 12) -> list[tuple[int, ...]]:
    """Two to four lengths that add up to the capacity exactly, ``counts[n]`` pieces being n long.

    All pairs are listed. Of triples and quadruples, each length gets the ``per_length`` whose rarest member is most
    common, so that the list is at most a few times ``capacity`` long.
    """
    capacity = len(counts) - 1
    have = np.flatnonzero(counts[:capacity])
    there = counts > 0
    found: set[tuple[int, ...]] = set()
    pairs: dict[int, list[tuple[int, int, int]]] = {}
    for a in have.tolist():
        if 2 * a >= capacity and there[capacity - a] and a < capacity:
            found.add((a, capacity - a))
    small = have[have <= capacity // 2]
    # The best two lengths for each sum, for the tails of triples and quadruples.
    for total in range(2, capacity):
        a = small[small * 2 <= total]
        a = a[there[total - a]]
        if len(a):
            scarce = np.minimum(counts[a], counts[total - a])
            top = np.argsort(-scarce, kind="stable")[:per_length]
            pairs[total] = [(int(scarce[i]), int(total - a[i]), int(a[i])) for i in top]
    for a in have.tolist():
        for _, b, c in pairs.get(capacity - a, ()):
            if b <= a:
                found.add((a, b, c))
    for total, left in pairs.items():
        right = pairs.get(capacity - total)
        if right and total * 2 >= capacity:
            for (_, a, b), (_, c, d) in zip(left[:3], right[:3]):
                found.add(tuple(sorted((a, b, c, d), reverse=True)))
    return sorted(found, reverse=True)


def fitted_repeats(patterns: list[tuple[int, ...]], counts: np.ndarray, sweeps: int = 40) -> np.ndarray:
    """Repeat counts x >= 0 that minimise the squared error of the lengths used against the histogram.

    Coordinate descent on one pattern at a time; with at most four lengths in each, a step touches four numbers.
    """
    scale = float(counts.max(initial=1))
    error = (counts / scale).tolist()
    uses = [sorted({n: p.count(n) for n in p}.items()) for p in patterns]
    norms = [float(sum(k * k for _, k in u)) for u in uses]
    x = [0.0] * len(patterns)
    for _ in range(sweeps):
        moved = 0.0
        for j, u in enumerate(uses):
            step = sum(k * error[n] for n, k in u) / norms[j]
            step = max(step, -x[j])
            if step:
                x[j] += step
                moved = max(moved, abs(step))
                for n, k in u:
                    error[n] -= k * step
        if moved < 1e-6:
            break
    return np.array(x) * scale


def packing_plan(counts: np.ndarray) -> list[tuple[int, tuple[int, ...]]]:
    """(repeats, lengths) of sequences that together take every piece of the histogram exactly once."""
    capacity = len(counts) - 1
    left = counts.astype(np.int64).copy()
    plan: list[tuple[int, tuple[int, ...]]] = []
    if left[capacity]:
        plan.append((int(left[capacity]), (capacity,)))
        left[capacity] = 0
    patterns = patterns_of(left)
    repeats = fitted_repeats(patterns, left)
    for j in np.argsort(-repeats, kind="stable").tolist():
        p = patterns[j]
        n = min([int(repeats[j] + 1e-9), *(int(left[v]) // p.count(v) for v in set(p))])
        if n > 0:
            plan.append((n, p))
            for v in p:
                left[v] -= n
    for p in patterns:  # what rounding left of exact fits
        n = min(int(left[v]) // p.count(v) for v in set(p))
        if n > 0:
            plan.append((n, p))
            for v in p:
                left[v] -= n
    return plan + best_fit(left)


def best_fit(left: np.ndarray) -> list[tuple[int, tuple[int, ...]]]:
    """Best fit, longest first. Bins with the same content are one entry with a count."""
    capacity = len(left) - 1
    room: dict[int, list[list]] = defaultdict(list)  # free length -> [count, lengths]
    for n in range(capacity, 0, -1):
        todo = int(left[n])
        while todo:
            free = min((f for f in room if f >= n), default=None)
            if free is None:  # only bins of other lengths so far: open new ones, as full of this length as they get
                each = min(capacity // n, todo)
                bins = todo // each
                room[capacity - each * n].append([bins, (n,) * each])
                todo -= bins * each
                continue
            entry = room[free][-1]
            take = min(entry[0], todo)
            entry[0] -= take
            room[free - n].append([take, (*entry[1], n)])
            todo -= take
            if not entry[0]:
                room[free].pop()
                if not room[free]:
                    del room[free]
    return [(count, lengths) for entries in room.values() for count, lengths in entries]


def _slots(plan: list[tuple[int, tuple[int, ...]]]) -> np.ndarray:
    """Rows of (length, first rank, first sequence, offset), ascending: where runs of pieces of a length go."""
    rank: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for repeats, lengths in plan:
        offset = 0
        for n in lengths:
            rows.append((n, rank[n], sequence, offset))
            rank[n] += repeats
            offset += n
        sequence += repeats
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(
    docs: DataFrame, capacity: int = 2048, end_id: int = 0, ranks_path: str = RANKS, json_path: str = TOKENIZER
) -> DataFrame:
    """Pieces of all documents with their sequence and their place in it.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset.
    """
    ws = Workspace(docs.sparkSession)
    pieces = ws.write(tokenised_pieces(docs, capacity, end_id, ranks_path, json_path))
    tallies = ws.write(pieces.groupBy("length", "task").count())
    counts = np.zeros(capacity + 1, np.int64)
    for row in tallies.groupBy("length").agg(F.sum("count").alias("n")).collect():  # at most one row per length
        counts[row.length] = row.n
    slots = _slots(packing_plan(counts))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tallies.select("length", "task", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32())]
        + [(n, pa.int64()) for n in ("start", "length", "ids_crc32", "sequence_id", "offset")]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = np.int64(1) << np.int64(48)
        keys = slots[:, 0] * wide + slots[:, 1]
        for b in batches:
            length, rank = (b.column(n).to_numpy() for n in ("length", "rank"))
            at = np.searchsorted(keys, length * wide + rank, "right") - 1
            kept = [b.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield batch(schema, *kept, slots[at, 2] + rank - slots[at, 1], slots[at, 3])

    ranked = pieces.join(offsets, ["length", "task"]).withColumn("rank", F.col("place") + F.col("before"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


@query()
def op10_best_fit_packing(spark, sf_dir):
    """All documents in sequences of at most 2048 tokens."""
    return pack(read_table(spark, sf_dir, "documents"))
