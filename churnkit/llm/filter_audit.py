"""What each filter removes, and what it would remove alone, in every order in which the filters can be applied.

A document fails a set of filters, a mask of five bits. Which step removes it under an order is the least place, in that
order, of the filters it fails: the min-plus product of the mask matrix (0 for a filter that it fails, infinite for one it
passes) and the inverse permutations (the place of each filter in each order). There are 32 masks and 120
orders, so the product is a small table that does not depend on the data; documents enter as the number of them with each
part, mask and label. These weights are scattered to the steps of all orders, and what the filters remove, find removed
already, remove alone and add on average follows from the table.

One pass over the texts counts words and characters and takes a digest of 128 bits; texts of equal digest are equal. That an
earlier document has the same text is known from the least doc_id per digest: rows meet it by digest and doc_id together,
so that rows of a text that a third of all documents have are spread by their ids.

Defined cases: a null text is empty, a null source is the part ''. A null doc_id is later than no document, has no labels
and is not smaller than any. Rows that repeat a doc_id count each, also with the same text, and none of them is a copy of the
other; a label is 1 if any row of ``labels`` says so. Extra columns are ignored. Without documents there are no parts and no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import Workspace, batch, read_table
from churnkit.llm.registry import query

NAMES = "ABCDE"
_COPY = 1 << NAMES.index("E")
_UPPER = bytes(range(65, 91))
_SIGNS = b"#$%&*|"
_INFINITE = 99
_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def own_mask(text: bytes) -> int:
    """Filters A to D that a text fails, as bits; they need no other document."""
    words = text.split()  # of bytes: at space and U+0009 to U+000D
    points = len(text) if text.isascii() else len(text.decode())
    upper = len(text) - len(text.translate(None, _UPPER))
    failed = (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * upper > 2 * points,
        len(text.translate(None, _SIGNS)) < len(text),
    )
    return sum(1 << i for i, f in enumerate(failed) if f)


def masked(docs: DataFrame) -> DataFrame:
    """doc_id, part, digest of the text and the mask of filters A to D of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("digest", pa.binary()), ("mask", pa.int32())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or b"" for t in b.column("text").to_pylist()]
            digests = [blake2b(t, digest_size=16).digest() for t in texts]
            yield batch(schema, b.column("doc_id"), b.column("part"), digests, [own_mask(t) for t in texts])

    source = F.col("source") if "source" in docs.columns else F.lit(None)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(source.cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("binary").alias("text"),
    )
    return rows.mapInArrow(judge, "doc_id long, part string, digest binary, mask int")


def tallied(ws: Workspace, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask of all five filters, good, toxic and n: how many documents there are of each kind."""
    rows = ws.write(masked(docs))
    kind = ["part", "mask", "good", "toxic"]
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    known = known.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    named = rows.where("doc_id is not null")
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    judged = named.join(first.hint("merge"), ["digest", "doc_id"], "left").join(known, "doc_id", "left")
    judged = judged.select(
        "part",
        F.when(F.col("first"), F.col("mask")).otherwise(F.col("mask") + F.lit(_COPY)).alias("mask"),
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")],
    )
    unnamed = rows.where("doc_id is null").select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    return judged.unionByName(unnamed).groupBy(*kind).agg(F.count("*").alias("n"))


def orders(n: int) -> np.ndarray:
    """All orders of n filters, one per row, ascending."""
    return np.array(list(permutations(range(n))), np.int64).reshape(-1, n)


def removal_steps(order: np.ndarray) -> np.ndarray:
    """The step, from 0, at which each order removes each mask; ``_INFINITE`` for the mask that fails nothing.

    The min-plus product of masks and inverse permutations: the least sum of cost and place over all filters.
    """
    n = order.shape[1]
    place = np.argsort(order, axis=1)
    fails = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
    cost = np.where(fails, 0, _INFINITE)
    return np.minimum((place[:, None, :] + cost[None, :, :]).min(axis=2), _INFINITE)


def audit(weights: np.ndarray, order: np.ndarray) -> dict[str, np.ndarray]:
    """Counts for every order and step. ``weights`` has a row of (all, good, toxic) documents for every mask."""
    m, n = order.shape
    steps = removal_steps(order)
    row, mask = np.nonzero(steps < _INFINITE)
    at = row * n + steps[row, mask]
    removed, good, toxic = (_scattered(at, w[mask], m * n).reshape(m, n) for w in weights.T)
    fails = ((np.arange(1 << n)[None, :, None] >> order[:, None, :]) & 1).astype(bool)  # by order, mask and step
    earlier = steps[:, :, None] < np.arange(n)
    redundant = np.einsum("omf,m->of", (fails & earlier).astype(np.int64), weights[:, 0])
    alone = weights[1 << np.arange(n), 0]
    in_all = _scattered(order.ravel(), removed.ravel(), n)
    return {
        "kept": weights[:, 0].sum() - np.cumsum(removed, axis=1),
        "removed": removed,
        "redundant": redundant,
        "unique_fails": alone[order],
        "good_lost": good,
        "toxic_lost": toxic,
        "shapley": in_all[order],
    }


def _scattered(at: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
    """Sums of whole numbers by place."""
    out = np.zeros(size, np.int64)
    np.add.at(out, at, weight)
    return out


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of every part, order and step; a part has at most 128 kinds of documents, so its table is small."""
    tally = tallied(Workspace(docs.sparkSession), docs, labels)
    order = orders(len(NAMES))
    names = ["".join(NAMES[i] for i in o) for o in order.tolist()]
    schema = pa.schema([("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())] + [(c, pa.int64()) for c in _COUNTS])

    def table(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        mask, good, toxic, n = (rows.column(c).to_numpy() for c in ("mask", "good", "toxic", "n"))
        weights = np.zeros((1 << len(NAMES), 3), np.int64)
        for i, some in enumerate((np.ones(len(n), bool), good.astype(bool), toxic.astype(bool))):
            weights[:, i] = _scattered(mask[some], n[some], len(weights))
        found = audit(weights, order)
        steps = np.tile(np.arange(1, len(NAMES) + 1), len(names))
        out = [[key[0].as_py()] * len(steps), np.repeat(names, len(NAMES)).tolist(), steps]
        return pa.Table.from_batches([batch(schema, *out, *[found[c].ravel() for c in _COUNTS])])

    types = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS)
    return tally.groupBy("part").applyInArrow(table, types)


_SQL = r"""
with t as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents
), w as (
  select *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from t
), known as (
  select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id
), f as (
  select part, len(w) < 200 as a, 100 * len(list_distinct(w)) < 50 * len(w) as b,
    100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text) as c,
    regexp_matches(text, '[#$%&*|]') as d,
    coalesce(min(w.doc_id) over (partition by text) < w.doc_id, false) as e,
    coalesce(good, false) as good, coalesce(toxic, false) as toxic
  from w left join known on known.doc_id = w.doc_id
), kinds as (
  select part, a, b, c, d, e, count(*) as n, count(*) filter (good) as g, count(*) filter (toxic) as x from f group by all
), letter as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as l
), orders as (
  select v.l || w.l || x.l || y.l || z.l as o from letter v, letter w, letter x, letter y, letter z
  where length(regexp_replace('ABCDE', '[' || v.l || w.l || x.l || y.l || z.l || ']', '', 'g')) = 0
), ranked as (
  select part, o, n, g, x, a, b, c, d, e, least(case when a then instr(o, 'A') end, case when b then instr(o, 'B') end,
    case when c then instr(o, 'C') end, case when d then instr(o, 'D') end, case when e then instr(o, 'E') end) as r
  from kinds cross join orders
), stepped as (
  select part, o, s, substr(o, s, 1) as l,
    sum(n) filter (r is null or r > s) as kept, sum(n) filter (r = s) as removed,
    sum(n) filter (fails and r < s) as redundant, sum(n) filter (fails and fewest = 1) as unique_fails,
    sum(g) filter (r = s) as good_lost, sum(x) filter (r = s) as toxic_lost
  from (select *, (substr(o, s, 1) = 'A' and a) or (substr(o, s, 1) = 'B' and b) or (substr(o, s, 1) = 'C' and c)
      or (substr(o, s, 1) = 'D' and d) or (substr(o, s, 1) = 'E' and e) as fails,
      a::int + b::int + c::int + d::int + e::int as fewest
    from ranked cross join (select unnest([1, 2, 3, 4, 5]) as s))
  group by part, o, s
)
select part, o as filter_order, s::int as step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
  coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
  coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
  coalesce(sum(removed) over (partition by part, l), 0)::bigint as shapley
from stepped
"""


@query(_SQL)
def op13_filter_interaction_audit(spark, sf_dir):
    """Five filters in all their orders, per source."""
    return audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
