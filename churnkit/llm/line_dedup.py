"""Lines that many documents share, found with two Bloom filters and dropped from all documents but one.

A first pass notes every long line's key in a filter of keys seen at all and a filter of keys seen twice. Filters of
parts of the data merge exactly: a key is seen twice if either part saw it twice, or if both saw it once. A second pass
shuffles only keys that the second filter suspects; these are counted exactly, so that a false suspicion costs
a row and never changes a result. The filter has a fixed number of bits (``filter_bits``, 16 MB as given). When
far more lines than that are read it suspects more of them, up to all; results stay the same.

Defined cases: a null or empty text is one empty line and keeps it. Lines are split at \\n alone, so \\r stays part of a
line and is stripped from its key only. Rows that repeat a doc_id count as one document and all get the same decision.
A row with a null doc_id counts towards no key and keeps all its lines. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.functions import named
from churnkit.llm.common import Workspace, batch, read_table, texts_of
from churnkit.llm.registry import query

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER_TO_LOWER = {c: c + 32 for c in range(65, 91)}
_PROBES = 4
_SLICE_BITS = 18
_SALTS = 16


def line_key(line: str) -> str:
    return line.strip(_BLANKS).translate(_UPPER_TO_LOWER)


def key_digest(line: str, min_chars: int) -> bytes | None:
    """128 bits that stand for the line's key; None for a key too short to count."""
    key = line_key(line)
    if len(key) < min_chars:
        return None
    return blake2b(key.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def _digests(text: str, min_chars: int) -> list[bytes | None]:
    return [key_digest(line, min_chars) for line in text.split("\n")]


def _probes(digests: list[bytes], bits: int) -> np.ndarray:
    """Bit numbers of each digest in a filter, one row per digest."""
    halves = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    steps = np.arange(_PROBES, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return (halves[:, :1] + steps * (halves[:, 1:] | np.uint64(1))) & np.uint64((1 << bits) - 1)


def _by_slice(positions: np.ndarray) -> dict[int, bytes]:
    """Bit numbers inside each slice of the filter."""
    positions = np.unique(positions)
    part = positions >> np.uint64(_SLICE_BITS)
    inside = (positions & np.uint64((1 << _SLICE_BITS) - 1)).astype("<u4")
    slices, first = np.unique(part, return_index=True)
    ends = [*first[1:].tolist(), len(positions)]
    return {int(s): inside[a:b].tobytes() for s, a, b in zip(slices, first.tolist(), ends)}


def twice_seen(docs: DataFrame, filter_bits: int, min_chars: int) -> bytes:
    """The filter of keys seen in two rows: one bit string of fixed size."""
    schema = pa.schema([("slice", pa.int32()), ("once", pa.binary()), ("twice", pa.binary())])
    out = pa.schema([("slice", pa.int32()), ("bits", pa.binary())])

    def note(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys: list[bytes] = []
            for text in texts_of(b.column("text")):
                keys += {d for d in _digests(text, min_chars) if d is not None}
            keys.sort()
            repeats = [a for a, c in zip(keys, keys[1:]) if a == c]
            once = _by_slice(_probes(keys, filter_bits))
            twice = _by_slice(_probes(repeats, filter_bits))
            yield batch(schema, list(once), list(once.values()), [twice.get(s) for s in once])

    def merge(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        seen = np.zeros(1 << _SLICE_BITS, np.int32)
        for blob in rows["once"].to_pylist():
            seen[np.frombuffer(blob, "<u4")] += 1  # a part names a bit once at most
        twice = seen > 1
        for blob in rows["twice"].to_pylist():
            if blob:
                twice[np.frombuffer(blob, "<u4")] = True
        return pa.Table.from_batches([batch(out, [key[0].as_py()], [np.packbits(twice, bitorder="little").tobytes()])])

    parts = docs.select("text").mapInArrow(note, "slice int, once binary, twice binary")
    merged = parts.groupBy("slice").applyInArrow(merge, "slice int, bits binary")
    size = (1 << _SLICE_BITS) // 8
    whole = bytearray((1 << filter_bits) // 8)
    for row in merged.collect():  # at most 2^filter_bits bits in all, whatever the input
        whole[row.slice * size : (row.slice + 1) * size] = row.bits
    return bytes(whole)


def _suspects(docs: DataFrame, twice: bytes, filter_bits: int, min_chars: int) -> DataFrame:
    """(key, doc_id) of every line that the filter suspects; each pair once per row of docs."""
    schema = pa.schema([("key", pa.binary()), ("doc_id", pa.int64())])
    shared = docs.sparkSession.sparkContext.broadcast(twice)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for b in batches:
            keys, ids = [], []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), texts_of(b.column("text"))):
                if doc_id is not None:
                    own = list({d for d in _digests(text, min_chars) if d is not None})
                    keys += own
                    ids += [doc_id] * len(own)
            if keys:
                at = _probes(keys, filter_bits)
                hit = ((bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)
                yield batch(schema, [k for k, h in zip(keys, hit) if h], np.array(ids)[hit])

    return docs.select("doc_id", "text").mapInArrow(pick, "key binary, doc_id long")


def dedup_lines(
    docs: DataFrame, min_docs: int = 5, min_chars: int = 40, filter_bits: int = 27, with_row: bool = False
) -> DataFrame:
    """Documents without the lines whose key, ``min_chars`` long or more, ``min_docs`` documents or more share.

    The document with the largest doc_id keeps such lines. Returns doc_id, text (what is left; null stays null), n_lines
    before dropping and n_dropped, and on request ``row``, a struct of all columns as they came.
    """
    if filter_bits < _SLICE_BITS:
        raise ValueError(f"filter_bits must be at least {_SLICE_BITS}")
    ws = Workspace(docs.sparkSession)
    twice = twice_seen(docs, filter_bits, min_chars)
    suspects = ws.write(_suspects(docs, twice, filter_bits, min_chars).distinct())
    shared = (
        suspects.groupBy("key")
        .agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_docs)
    )
    # A key that a third of the documents hold would meet in one task: each meets its keeper in one of several.
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    lost = (
        suspects.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)).cast("int"))
        .join(shared.select("key", "keeper", salts.alias("salt")), ["key", "salt"])
        .where(F.col("doc_id") < F.col("keeper"))
        .groupBy("doc_id")
        .agg(F.collect_list("key").alias("lost"))
    )
    lost = ws.write(lost)
    ws.drop(suspects)
    row = F.struct(*[named(c) for c in docs.columns]).alias("row")
    held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[row] * with_row)
    # One plan at every size: the texts meet their lost lines in a merge join, never in a broadcast.
    joined = held.join(lost.hint("merge"), "doc_id", "left")
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in held.schema.fields) + ", n_lines long, n_dropped long"
    names = ["doc_id", "text", *["row"] * with_row, "n_lines", "n_dropped"]

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, gone in zip(b.column("text").to_pylist(), b.column("lost").to_pylist()):
                lines = (text or "").split("\n")
                left = lines
                if gone:
                    gone = set(gone)
                    left = [x for x in lines if key_digest(x, min_chars) not in gone]
                texts.append(None if text is None else "\n".join(left))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(left))
            columns = [b.column("doc_id"), pa.array(texts, pa.string()), *([b.column("row")] if with_row else [])]
            columns += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(drop, out)


_SQL = """
with split as (
  select doc_id, generate_subscripts(l, 1) as i, unnest(l) as line
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)
), keyed as (
  select doc_id, i, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from split
), shared as (
  select k, max(doc_id) as keeper from keyed where length(k) >= 40 group by k having count(distinct doc_id) >= 5
), marked as (
  select doc_id, i, line, keeper is not null and doc_id < keeper as gone from keyed left join shared using (k)
)
select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""


@query(_SQL)
def op5_line_dedup(spark, sf_dir):
    """Lines of 40 characters or more that 5 documents share are left in the last of them only."""
    done = dedup_lines(read_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
