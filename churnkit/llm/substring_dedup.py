"""Word passages that an earlier document already has, found through anchors and removed.

Every document is cut into blocks of ``BLOCK`` words that do not overlap; these are the reference blocks. Every rolling
window of as many words probes them. A passage of 2 * BLOCK - 1 = 13 words holds a whole block of its reference wherever
it begins, so no repeated window of ``WINDOW`` words is missed. A hash that is a reference block of one document and a
window of another is an anchor. Windows of 13 words around anchors are compared by hashes of 63 bits, by the smallest doc_id
that has them, and neighbouring ones extend to maximal repeats.

Documents are handled in chunks of about ``chunk_bytes`` of text, formed from a hash of their id and text, so that rows
without an id or with the same one are spread. A chunk sends every
hash once, whatever number of its documents repeat it, ascending and packed, so that a window that a third of all documents
hold costs one number per chunk; what comes back to a chunk are its own anchors, then its own repeated windows. Hashes
have 16 bits more than it takes to number the words of the input, and full length where windows are compared.

Defined cases: a null or empty text has no words and keeps none. A row with a null doc_id loses nothing and is no one's
reference. Rows with the same doc_id are one document: neither is earlier than the other. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import Workspace, batch, chunk_of, pack, parts_for, read_table, text_bytes, texts_of, unpack
from churnkit.llm.registry import query
from churnkit.llm.words import Words, covered, split_words

WINDOW = 13
BLOCK = 7
_U = np.uint64
_PARTS = "bucket long, chunk long, hashes binary, ids binary"
_PARTS_SCHEMA = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("ids", pa.binary())])


def _read(docs: pa.Table) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words, ids, and which documents have an id."""
    words = split_words([t.encode() for t in texts_of(docs.column("text"))])
    ids = docs.column("doc_id").combine_chunks()
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    return words, ids.fill_null(0).to_numpy(zero_copy_only=False), known


def _grouped(hashes: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hashes in ascending order, where each new one begins, and the columns in the same order."""
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    begin = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.empty(0, np.int64)
    return hashes, begin, *[c[order] for c in columns]


def _split(hashes: np.ndarray, bits: int, buckets: int) -> list[tuple[int, slice]]:
    """Ranges of ascending hashes of so many bits, by bucket."""
    if not len(hashes):
        return []
    top = hashes >> _U(bits - 32) if bits > 32 else hashes << _U(32 - bits)
    bucket = (top * _U(buckets)) >> _U(32)
    edges = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(hashes)]
    return [(int(bucket[a]), slice(a, b)) for a, b in zip(edges, edges[1:])]


def _anchors(docs: DataFrame, chunks: int, buckets: int, bits: int) -> DataFrame:
    """(chunk, hashes): which hashes of a chunk are a reference block of one document and a window of another."""
    out = pa.schema([("chunk", pa.int64()), ("hashes", pa.binary())])

    def send(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        words, ids, known = _read(rows)
        hashes, at = words.windows(BLOCK)
        doc = words.doc[at]
        use = known[doc]
        block = (at - words.first[doc]) % BLOCK == 0
        hashes, begin, own, block = _grouped(hashes[use] >> _U(64 - bits), ids[doc[use]], block[use])
        if not len(begin):
            return _PARTS_SCHEMA.empty_table()
        several = np.minimum.reduceat(own, begin) < np.maximum.reduceat(own, begin)
        flags = several.astype(_U) | (np.logical_or.reduceat(block, begin).astype(_U) << _U(1))
        values = (hashes[begin] << _U(2)) | flags
        parts = _split(hashes[begin], bits, buckets)
        chunk = [key[0].as_py()] * len(parts)
        packed = [pack(values[s]) for _, s in parts]
        return pa.Table.from_batches([batch(_PARTS_SCHEMA, [b for b, _ in parts], chunk, packed, [None] * len(parts))])

    def meet(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        packed = [unpack(x) for x in rows.column("hashes").to_pylist()]
        part = np.repeat(np.arange(len(packed)), [len(x) for x in packed])
        values, begin, part = _grouped_by_hash(np.concatenate(packed), part)
        several = np.diff([*begin, len(values)]) > 1
        several |= np.logical_or.reduceat((values & _U(1)).astype(bool), begin)
        hit = several & np.logical_or.reduceat((values & _U(2)).astype(bool), begin)
        chosen = np.repeat(hit, np.diff([*begin, len(values)]))
        hashes, part = values[chosen] >> _U(2), part[chosen]
        back = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[back], np.arange(len(packed) + 1))
        found = [hashes[back[a:b]] for a, b in zip(edges, edges[1:])]
        keep = [i for i, f in enumerate(found) if len(f)]
        chunk = rows.column("chunk").to_pylist()
        return pa.Table.from_batches([batch(out, [chunk[i] for i in keep], [pack(found[i]) for i in keep])])

    sent = docs.groupBy("chunk").applyInArrow(send, _PARTS).drop("ids")
    return sent.groupBy("bucket").applyInArrow(meet, "chunk long, hashes binary")


def _grouped_by_hash(values: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``_grouped``, for hashes that carry two flags at the end."""
    order = np.argsort(values, kind="stable")
    values = values[order]
    same = (values[1:] >> _U(2)) != (values[:-1] >> _U(2))
    return values, np.flatnonzero(np.concatenate([[True], same])), part[order]


def _around(words: Words, anchors: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (of 63 bits) and starts of the windows of 13 words that hold an anchor."""
    single = words.hashes()
    blocks, at = words.windows(BLOCK, single)
    short = blocks >> _U(64 - bits)
    place = np.minimum(np.searchsorted(anchors, short), max(len(anchors) - 1, 0))
    found = anchors[place] == short if len(anchors) else np.zeros(len(short), bool)
    marks = np.zeros(len(single) + 1, np.int64)
    marks[at[found] + 1] = 1
    marks = np.cumsum(marks)
    last = np.repeat(words.first[1:], np.diff(words.first)) - WINDOW
    start = np.flatnonzero(np.arange(len(single)) <= last)
    start = start[marks[start + WINDOW - BLOCK + 1] > marks[start]]
    return words._joined(single, start, WINDOW) >> _U(1), start


def _united(blobs: list[bytes]) -> np.ndarray:
    return np.sort(np.concatenate([unpack(x) for x in blobs])) if blobs else np.empty(0, _U)


def _repeats(docs: DataFrame, anchors: DataFrame, buckets: int, bits: int) -> DataFrame:
    """(chunk, hashes, ids): windows of a chunk that some document of smaller id has, and the smallest such id."""
    out = pa.schema([("chunk", pa.int64()), ("hashes", pa.binary()), ("ids", pa.binary())])

    def send(key: tuple[pa.Scalar, ...], rows: pa.Table, found: pa.Table) -> pa.Table:
        if not found.num_rows or not rows.num_rows:
            return _PARTS_SCHEMA.empty_table()
        words, ids, known = _read(rows)
        hashes, start = _around(words, _united(found.column("hashes").to_pylist()), bits)
        doc = words.doc[start]
        use = known[doc]
        hashes, begin, own = _grouped(hashes[use], ids[doc[use]])
        if not len(begin):
            return _PARTS_SCHEMA.empty_table()
        least = np.minimum.reduceat(own, begin)
        several = least < np.maximum.reduceat(own, begin)
        values = (hashes[begin] << _U(1)) | several.astype(_U)
        parts = _split(hashes[begin], 63, buckets)
        columns = [[b for b, _ in parts], [key[0].as_py()] * len(parts)]
        columns += [[pack(values[s]) for _, s in parts], [least[s].astype("<i8").tobytes() for _, s in parts]]
        return pa.Table.from_batches([batch(_PARTS_SCHEMA, *columns)])

    def meet(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        packed = [unpack(x) for x in rows.column("hashes").to_pylist()]
        own = np.concatenate([np.frombuffer(x, "<i8") for x in rows.column("ids").to_pylist()])
        part = np.repeat(np.arange(len(packed)), [len(x) for x in packed])
        values = np.concatenate(packed)
        order = np.argsort(values >> _U(1), kind="stable")
        values, own, part = values[order], own[order], part[order]
        begin = np.flatnonzero(np.concatenate([[True], (values[1:] >> _U(1)) != (values[:-1] >> _U(1))]))
        least = np.repeat(np.minimum.reduceat(own, begin), np.diff([*begin, len(values)]))
        # A chunk whose only document with the window is the first of all has nothing to remove.
        chosen = (least < own) | (values & _U(1)).astype(bool)
        hashes, least, part = values[chosen] >> _U(1), least[chosen], part[chosen]
        back = np.argsort(part, kind="stable")
        edges = np.searchsorted(part[back], np.arange(len(packed) + 1))
        rows_of = [(i, back[a:b]) for i, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
        chunk = rows.column("chunk").to_pylist()
        columns = [[chunk[i] for i, _ in rows_of], [pack(hashes[r]) for _, r in rows_of]]
        return pa.Table.from_batches([batch(out, *columns, [least[r].astype("<i8").tobytes() for _, r in rows_of])])

    sent = docs.groupBy("chunk").cogroup(anchors.groupBy("chunk")).applyInArrow(send, _PARTS)
    return sent.groupBy("bucket").applyInArrow(meet, "chunk long, hashes binary, ids binary")


def _runs(marked: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], marked.astype(np.int8), [0]])))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])]


def remove_repeats(docs: DataFrame, chunk_bytes: int = 8 << 20, bucket_bytes: int = 12 << 20) -> DataFrame:
    """doc_id, n_words, n_removed, ``spans`` of removed words (start and end) and text: the words left, a space between."""
    ws = Workspace(docs.sparkSession)
    size = text_bytes(docs)
    chunks, buckets = parts_for(size, chunk_bytes), parts_for(size, bucket_bytes)
    bits = min(62, max(1, size // 2).bit_length() + 16)
    keyed = docs.select(chunk_of(chunks, "doc_id", "text").alias("chunk"), "doc_id", "text")
    anchors = ws.write(_anchors(keyed, chunks, buckets, bits))
    repeats = ws.write(_repeats(keyed, anchors, buckets, bits))
    ws.drop(anchors)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", span), ("text", pa.string())]
    )

    def clean(key: tuple[pa.Scalar, ...], rows: pa.Table, found: pa.Table) -> pa.Table:
        words, ids, known = _read(rows)
        blobs = found.column("hashes").to_pylist()
        repeated = np.concatenate([unpack(x) for x in blobs]) if blobs else np.empty(0, _U)
        least = np.concatenate([np.frombuffer(x, "<i8") for x in found.column("ids").to_pylist()] or [np.empty(0, "<i8")])
        order = np.argsort(repeated)
        repeated, least = repeated[order], least[order]
        gone = np.zeros(len(words.start), bool)
        if len(repeated):
            hashes, at = words.windows(WINDOW)
            hashes >>= _U(1)
            place = np.minimum(np.searchsorted(repeated, hashes), len(repeated) - 1)
            doc = words.doc[at]
            hit = (repeated[place] == hashes) & (least[place] < ids[doc]) & known[doc]
            gone = covered(at[hit], WINDOW, len(words.start))
        raw = words.data.tobytes()
        removed = words.words_per_doc(gone)
        texts, spans = [], []
        for i, (a, b) in enumerate(zip(words.first.tolist(), words.first[1:].tolist())):
            own = raw[words.bounds[i] : words.bounds[i + 1]].split()
            marks = gone[a:b]
            spans.append(_runs(marks) if removed[i] else [])
            texts.append(b" ".join([w for w, g in zip(own, marks.tolist()) if not g] if removed[i] else own).decode())
        columns = [rows.column("doc_id").combine_chunks(), np.diff(words.first), removed, spans, texts]
        return pa.Table.from_batches([batch(schema, *columns)])

    return keyed.groupBy("chunk").cogroup(repeats.groupBy("chunk")).applyInArrow(
        clean, "doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, text string"
    )


_SQL = r"""
with w as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents
), g as (
  select doc_id, s, array_to_string(w[s:s + 12], ' ') as win
  from (select doc_id, w, unnest(generate_series(1, len(w) - 12)) as s from w where len(w) >= 13)
), least as (
  select win, min(doc_id) as first from g group by win having min(doc_id) < max(doc_id)
), gone as (
  select distinct doc_id, p from (
    select g.doc_id, unnest(generate_series(s, s + 12)) as p from g join least using (win) where g.doc_id > least.first
  )
), each as (
  select doc_id, unnest(w) as word, unnest(generate_series(1, len(w))) as p from w where len(w) > 0
), kept as (
  select e.doc_id, string_agg(word, ' ' order by e.p) as text, count(*) as n
  from each e left join gone x on x.doc_id = e.doc_id and x.p = e.p where x.p is null group by e.doc_id
)
select w.doc_id, len(w.w)::bigint as n_words, (len(w.w) - coalesce(n, 0))::bigint as n_removed,
  sha256(coalesce(kept.text, '')) as kept_sha256
from w left join kept using (doc_id)
"""


@query(_SQL)
def op8_substring_dedup(spark, sf_dir):
    """Passages of 13 words or more that a document of smaller id has are removed."""
    done = remove_repeats(read_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
