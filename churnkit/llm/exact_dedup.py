"""Equal documents through an extendible-hash index whose buckets are key ranges of shared files.

A first pass writes the index: every task keeps a table of the texts it has met, lower-cased from A to Z, and writes one
entry per text and part: hash, digest, text, and the ids of all rows that have it. A part ends after ``PART_BYTES`` of
texts or ``PART_ROWS`` rows, so that an entry is bounded, and however often a text is copied, only one row per part
goes on. Hashes with one entry are settled. For the others a directory is built: its slots are the first bits of
a hash, several slots may lead to one bucket, an overfull bucket is split by its next bit, and the directory doubles when
the bucket was as deep as itself. Each bucket is a range of hashes, owned by one task. The owner reads
its entries in the order of their hashes, chains entries of one hash, and tells them apart byte by byte. What it
finds out goes back to the entries by part and digest, a key that no two entries share, so that a text that a third
of all rows have is spread over its parts.

The directory has at most 2 ** MAX_DEPTH slots and one bucket per ``capacity`` bytes of entries; both are small
tables whatever the input. An owner's memory holds the texts of one chain, which is one text unless hashes collide, and a
number for every part that has it.

Defined cases: a null text counts as empty, and empty texts are equal. A row with a null doc_id is a member of its
group and stays only if no member has an id; of several rows that could stay one does. Rows that repeat a doc_id are members
each. Extra columns are ignored by ``dedup_exact`` and pass through ``drop_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import Workspace, batch, read_table
from churnkit.llm.registry import query

PART_BYTES = 32 << 20
PART_ROWS = 8192
CAPACITY = 32 << 20
MAX_DEPTH = 20
_SMALL = 1_000_000
_ENTRY_BYTES = 100
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_INDEX = "h long, part long, digest binary, ids array<long>, n_bytes long, text binary"
_FOUND = "part long, digest binary, keep_id long, keep_part long, group_size long"


def normalised(text: bytes | None) -> bytes:
    return (text or b"").translate(_LOWER)


def build_index(docs: DataFrame, hash_bits: int = 64, part_rows: int = PART_ROWS) -> DataFrame:
    """One entry per part and text: hash, part, digest, ids of its rows, and the text."""
    schema = pa.schema([
        ("h", pa.int64()), ("part", pa.int64()), ("digest", pa.binary()),
        ("ids", pa.list_(pa.int64())), ("n_bytes", pa.int64()), ("text", pa.binary()),
    ])

    def entries(part: int, met: dict[bytes, list]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for text, ids in met.items():
            h = xxhash.xxh3_64_intdigest(text) >> (64 - hash_bits) << (64 - hash_bits)
            rows.append((h - (1 << 64) if h >> 63 else h, part, sha256(text).digest(), ids, len(text), text))
            held += len(text)
            if held > 1 << 22 or len(rows) == 4096:
                yield batch(schema, *map(list, zip(*rows)))
                rows, held = [], 0
        if rows:
            yield batch(schema, *map(list, zip(*rows)))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        met: dict[bytes, list] = {}
        n_rows = n_bytes = 0
        for b in batches:
            for doc_id, raw in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                text = normalised(raw)
                ids = met.get(text)
                if ids is None:
                    met[text] = [doc_id]
                    n_bytes += len(text)
                else:
                    ids.append(doc_id)
                n_rows += 1
                if n_rows == part_rows or n_bytes > PART_BYTES:
                    yield from entries(part, met)
                    part, met, n_rows, n_bytes = part + 1, {}, 0, 0
        yield from entries(part, met)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(index, _INDEX)


class Directory:
    """Slots of the first ``depth`` bits of a hash, each with the number of its bucket.

    ``load`` and ``keys`` have the bytes and the different hashes below each prefix of ``bits`` bits.
    """

    def __init__(self, load: np.ndarray, keys: np.ndarray, capacity: int):
        bits = len(load).bit_length() - 1
        loads, counts = (np.concatenate([[0], np.cumsum(a)]) for a in (load, keys))
        self.depth = 0
        self.slots = [0]
        self.local = [0]  # depth of each bucket
        first = [0]  # each bucket's first prefix, of ``bits`` bits
        work = [0]
        while work:
            bucket = work.pop()
            deep, low = self.local[bucket], first[bucket]
            high = low + (1 << (bits - deep))
            if deep == bits or loads[high] - loads[low] <= capacity or counts[high] - counts[low] < 2:
                continue
            if deep == self.depth:  # every slot becomes two
                self.slots = [s for s in self.slots for _ in range(2)]
                self.depth += 1
            new = len(self.local)
            self.local[bucket] += 1
            self.local.append(deep + 1)
            first.append((low + high) // 2)
            a, b = (p >> (bits - self.depth) for p in (first[new], high))
            self.slots[a:b] = [new] * (b - a)
            work += [bucket, new]

    @property
    def buckets(self) -> int:
        return len(self.local)


def _prefix(bits: int):
    return F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")


def directory_of(crowded: DataFrame, capacity: int) -> Directory:
    """The directory for hashes with their bytes: one count per prefix, and of prefixes 16 per bucket at most."""
    total = crowded.agg(F.sum("load").alias("n")).first().n or 0
    bits = min(MAX_DEPTH, max(1, (16 * total // capacity).bit_length()))
    load, keys = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
    tally = crowded.groupBy(_prefix(bits).alias("prefix")).agg(F.sum("load").alias("load"), F.count("*").alias("n"))
    for r in tally.toLocalIterator():
        load[r.prefix], keys[r.prefix] = r["load"], r.n
    return Directory(load, keys, capacity)


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= _SMALL else df.hint("merge")


def _chained(entries: DataFrame) -> DataFrame:
    """What the owners find out: for every entry the id that stays, the part it is in, and the size of the group.

    Entries come in the order of bucket and hash, so a chain ends where the hash changes.
    """
    schema = pa.schema([
        ("part", pa.int64()), ("digest", pa.binary()), ("keep_id", pa.int64()), ("keep_part", pa.int64()), ("group_size", pa.int64()),
    ])

    def settle(chain: list[list]) -> Iterator[pa.RecordBatch]:
        for _, digest, keep, keep_part, size, parts in chain:
            for i in range(0, len(parts), 1 << 16):
                own = parts[i : i + (1 << 16)]
                m = len(own)
                yield batch(schema, own, [digest] * m, [keep] * m, [keep_part] * m, [size] * m)

    def owner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain: list[list] = []
        now = None
        for b in batches:
            for h, part, digest, keep, n, text in zip(*(b.column(c).to_pylist() for c in ("h", "part", "digest", "keep", "n", "text"))):
                if h != now:
                    yield from settle(chain)
                    chain, now = [], h
                for link in chain:
                    if link[0] == text:
                        if keep is not None and (link[2] is None or keep > link[2]):
                            link[2], link[3] = keep, part
                        link[4] += n
                        link[5].append(part)
                        break
                else:
                    chain.append([text, digest, keep, part, n, [part]])
        yield from settle(chain)

    return entries.select("h", "part", "digest", "keep", "n", "text").mapInArrow(owner, _FOUND)


def _resolved(ws: Workspace, index: DataFrame, capacity: int) -> DataFrame:
    """part, digest, keep_id, keep_part and group_size of all entries whose hash has another entry."""
    load = F.sum(F.col("n_bytes") + F.lit(_ENTRY_BYTES)).alias("load")
    crowded = ws.write(index.groupBy("h").agg(F.count("*").alias("m"), load).where("m > 1").select("h", "load"))
    directory = directory_of(crowded, capacity)
    slots = list(enumerate(directory.slots))
    leads = index.sparkSession.createDataFrame(slots, "slot long, bucket int")
    entries = index.select(
        "h", "part", "digest", F.array_max("ids").alias("keep"), F.size("ids").cast("long").alias("n"), "text",
        _prefix(directory.depth).alias("slot"),
    )
    entries = entries.join(_small(crowded.select("h")), "h", "left_semi").join(F.broadcast(leads), "slot")
    owned = entries.repartition(directory.buckets, "bucket").sortWithinPartitions("bucket", "h", "part")
    found = ws.write(_chained(owned))
    ws.drop(crowded)
    return found


def _decided(docs: DataFrame, capacity: int = CAPACITY, hash_bits: int = 64, part_rows: int = PART_ROWS) -> DataFrame:
    """doc_id, keep_id, group_size, kept and the digest of the text of every row of docs."""
    ws = Workspace(docs.sparkSession)
    index = ws.write(build_index(docs, hash_bits, part_rows))
    found = _resolved(ws, index, capacity)
    own = index.select("part", "digest", "ids").join(found.hint("merge"), ["part", "digest"], "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.array_max("ids")).otherwise(F.col("keep_id"))
    held = own.select(
        keep.alias("keep_id"),
        F.coalesce("group_size", F.size("ids").cast("long")).alias("group_size"),
        "digest",
        (alone | (F.col("keep_part") == F.col("part"))).alias("here"),
        F.coalesce(F.array_position("ids", keep), F.lit(1)).alias("at"),
        F.posexplode("ids").alias("place", "doc_id"),
    )
    kept = F.col("here") & (F.col("place") + 1 == F.col("at"))
    return held.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "digest")


def dedup_exact(docs: DataFrame, **options) -> DataFrame:
    """doc_id, keep_id (the largest of equal texts), group_size, kept and text_sha256 of every row of docs.

    ``capacity`` is the bytes of a bucket, ``hash_bits`` how many bits of the hash count, ``part_rows`` the rows of a part.
    """
    done = _decided(docs, **options)
    return done.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """The rows that stay, with all their columns; of rows that agree in doc_id and normalised text any one."""
    ws = Workspace(docs.sparkSession)
    stays = ws.write(_decided(docs, **options).where("kept").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")))
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    own = "_" * (1 + max(map(len, docs.columns)))  # a name that no column of docs has
    keyed = docs.withColumn(own, F.unhex(F.sha2(lower, 256)))
    same = keyed["doc_id"].eqNullSafe(stays["_id"]) & (keyed[own] == stays["_digest"])
    return keyed.join(stays, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)


_SQL = """
with n as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
  row_number() over (partition by t order by doc_id desc nulls last) = 1 as kept, sha256(t) as text_sha256
from n
"""


@query(_SQL)
def op11_exact_dedup(spark, sf_dir):
    """Groups of equal documents and the row of each that stays."""
    return dedup_exact(read_table(spark, sf_dir, "documents"))
