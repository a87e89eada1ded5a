"""Documents that repeat passages of benchmark items, found by winnowing and confirmed word by word.

Words are hashed, runs of ``GRAM`` words are hashed from these, and of every ``RUN`` such hashes in a row the least is a
fingerprint. Two texts that share a span of GRAM + RUN - 1 = 10 words have all hashes of the span in common, so the
least of them as well: no shared span of a window's length is missed. Documents and items that share a fingerprint are
candidates; their windows of 10 words are joined as text, and hits that touch are extended to spans. An item of fewer
words is one window; its hash is looked up among all runs of that many words, for every such length the items have.

Everything is column expressions and joins. The benchmark side is broadcast only while it has at most ``SMALL`` rows,
and candidates likewise; beyond that both are merge joins.

Defined cases: a null text has no words, and no hits. Items with a null item_id or without words are ignored. Rows that
repeat an item_id are one item. Each row of documents is judged by its own text, also if a doc_id repeats or is null.
Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import Workspace, read_table
from churnkit.llm.registry import query

WINDOW = 10
GRAM = 5
RUN = WINDOW - GRAM + 1
SMALL = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of ASCII letters, digits and anything beyond ASCII; A to Z in lower case."""
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lower, _BETWEEN), "")


def _runs(items: Column, size: int, make) -> Column:
    """``make`` of each run of ``size`` elements; empty if there are fewer."""
    starts = F.sequence(F.lit(1), F.size(items) - F.lit(size - 1))
    return F.when(F.size(items) >= size, F.transform(starts, lambda i: make(F.slice(items, i, size)))).otherwise(F.array())


def _fingerprinted(df: DataFrame, short: list[int]) -> DataFrame:
    """Adds ``prints``: the winnowed fingerprints of ``words``, and the hashes of all runs of the ``short`` lengths."""
    # One column a step: an expression that is used inside a lambda would be worked out again for each element.
    df = df.withColumn("hashed", F.transform("words", lambda w: F.xxhash64(w)))
    df = df.withColumn("grams", _runs(F.col("hashed"), GRAM, F.xxhash64))
    kinds = [_runs(F.col("grams"), RUN, F.array_min), *[_runs(F.col("hashed"), m, F.xxhash64) for m in short]]
    return df.withColumn("prints", F.array_distinct(F.concat(*kinds) if short else kinds[0])).drop("hashed", "grams")


def _windows(df: DataFrame, short: list[int]) -> DataFrame:
    """(start, size, window) of every run of ``WINDOW`` words and of the ``short`` lengths; the window as text."""
    kinds = [
        F.transform(_runs(F.col("words"), m, lambda s: F.concat_ws(" ", s)), lambda w, i: F.struct(i.alias("start"), F.lit(m).alias("size"), w.alias("window")))
        for m in (*short, WINDOW)
    ]
    return df.select(*[c for c in df.columns if c != "words"], F.inline(F.concat(*kinds)))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast, as long as its rows are few."""
    return F.broadcast(df) if df.count() <= SMALL else df.hint("merge")


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, digest of the text, n_words, ``spans`` (start and end words of hits, joined) and ``items`` per row of docs.

    ``spans`` and ``items`` are null for documents without a hit. Rows with the same doc_id and text are listed once.
    """
    ws = Workspace(docs.sparkSession)
    items = benchmark.where(F.col("item_id").isNotNull()).select("item_id", words_of(F.col("text")).alias("words"))
    items = ws.write(items.where(F.size("words") > 0))
    lengths = items.where(F.size("words") < WINDOW).select(F.size("words").alias("m")).distinct()
    short = sorted(r.m for r in lengths.collect())  # at most nine numbers
    prints = _fingerprinted(items, []).select(F.explode("prints").alias("print"))
    whole = F.transform("words", lambda w: F.xxhash64(w))
    prints = prints.union(items.where(F.size("words") < WINDOW).select(F.xxhash64(whole).alias("print")))
    prints = ws.write(prints.distinct().withColumn("known", F.lit(True)))

    rows = docs.select("doc_id", F.xxhash64("text").alias("digest"), words_of(F.col("text")).alias("words"))
    read = rows.withColumn("n_words", F.size("words").cast("long"))
    marked = _fingerprinted(read, short).select("doc_id", "digest", "n_words", F.explode_outer("prints").alias("print"))
    marked = marked.join(_small(prints), "print", "left").groupBy("doc_id", "digest")
    marked = ws.write(marked.agg(F.first("n_words").alias("n_words"), F.max("known").alias("known")))

    candidates = _small(marked.where("known").select(F.col("doc_id").alias("id"), F.col("digest").alias("d")))
    chosen = rows.join(candidates, F.expr("doc_id <=> id and digest = d"), "left_semi").distinct()
    wanted = _windows(items.withColumn("n", F.size("words")), short)
    wanted = wanted.where(F.expr(f"size = {WINDOW} or size = n")).groupBy("window", "size")
    wanted = ws.write(wanted.agg(F.collect_set("item_id").alias("found")))
    hits = _windows(chosen, short).join(_small(wanted), ["window", "size"]).groupBy("doc_id", "digest")
    hits = hits.agg(
        F.sort_array(F.collect_set(F.struct(F.col("start"), (F.col("start") + F.col("size")).alias("end")))).alias("hit"),
        F.array_distinct(F.flatten(F.collect_set("found"))).alias("items"),
    )
    spans = F.aggregate(
        "hit",
        F.expr("cast(array() as array<struct<start: int, end: int>>)"),
        lambda done, h: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= h["start"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], h["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(F.struct(h["start"].alias("start"), h["end"].alias("end"))))),
    )
    hits = hits.select(F.col("doc_id").alias("id"), F.col("digest").alias("d"), spans.alias("spans"), "items")
    return marked.drop("known").join(hits.hint("merge"), F.expr("doc_id <=> id and digest = d"), "left").drop("id", "d")


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated, one row per row of docs."""
    leaks = find_leaks(docs, benchmark)
    copies = docs.groupBy("doc_id", F.xxhash64("text").alias("digest")).agg(F.count("*").alias("copies"))
    copies = copies.where("copies > 1").select(F.col("doc_id").alias("id"), F.col("digest").alias("d"), "copies")
    whole = leaks.join(copies, F.expr("doc_id <=> id and digest = d"), "left")
    times = F.explode(F.sequence(F.lit(1), F.coalesce("copies", F.lit(1)).cast("int")))
    whole = whole.withColumn("copy", times)
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    names = F.array_sort(F.transform(F.coalesce("items", F.array().cast("array<bigint>")), lambda i: i.cast("string")))
    n_hit = F.coalesce(covered, F.lit(0).cast("long"))
    return whole.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any hit, with all their columns."""
    ws = Workspace(docs.sparkSession)
    leaked = find_leaks(docs, benchmark).where(F.col("spans").isNotNull())
    leaked = _small(ws.write(leaked.select("doc_id", "digest")))
    same = docs["doc_id"].eqNullSafe(leaked["doc_id"]) & (F.xxhash64(docs["text"]) == leaked["digest"])
    return docs.join(leaked, same, "left_anti")


_SQL = r"""
with w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents
), i as (
  select item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark
), size as (
  select item_id, w, least(len(w), 10) as m from i where len(w) > 0
), want as (
  select distinct item_id, m, array_to_string(w[s:s + m - 1], ' ') as win
  from (select item_id, w, m, unnest(generate_series(1, len(w) - m + 1)) as s from size)
), hit as (
  select distinct d.doc_id, d.s, d.m, want.item_id
  from (select doc_id, s, m, array_to_string(w[s:s + m - 1], ' ') as win
        from (select doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) as s
              from w cross join (select distinct m from size) where len(w) >= m)) d
  join want on want.win = d.win and want.m = d.m
), covered as (
  select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(generate_series(s, s + m - 1)) as p from hit)
  group by doc_id
), found as (
  select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
  from (select distinct doc_id, item_id::varchar as id from hit) group by doc_id
)
select w.doc_id, len(w.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join covered using (doc_id) left join found using (doc_id)
"""


@query(_SQL)
def op4_benchmark_decontamination(spark, sf_dir):
    """Benchmark passages in every document."""
    return leak_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
