"""Documents linked by the Jaccard similarity of their word shingles, through token-combination prefixes.

A document is the set of its runs of five words; runs are the tokens, in a global order of rare before frequent. Documents
whose similarity reaches the threshold share so many tokens that the beginnings of both, in that order, must meet. How
long a beginning has to be depends on what is indexed from it: a rare token alone is a key, frequent tokens are keys in
pairs. Frequent tokens fall into classes, and only pairs within a class are keys; a beginning with tokens of c classes is
extended by c tokens, since c + 1 common ones put two into the same class. The beginning of the smaller of two sets may be
shorter than that of the larger, so each key tells in which of the two parts its set has it.

The order is that of the exact number of sets that have a token. Documents are read in parts of ``_PART_ROWS``; a part
sends each of its tokens once, with the number of its sets that have it, so a token that a third of all documents have
costs one entry a part. Where a token's entries meet, its number is known, and tokens of a single set end there. Back at
its part a set knows how many of its tokens any other set has: if these are too few to reach the threshold it is done.
Most documents are. A pair that shares a key is compared only if its sizes, and the tokens that either shares with any set
at all, leave a link possible; a passage that stands in thousands of otherwise unlike documents makes no pairs thereby.

Documents with the same set are one class and take part once. For some of the keys the classes that share one are
compared with that of them which has fewest tokens of its own alone; then all possible pairs of keys with unconnected classes
are. Parity sketches prove that sets differ too much, inside the join and again at their full size, and the rest
are compared exactly. A large group of near copies therefore costs a few pairs for each member, and no link between different
texts is lost.

Defined cases: a null text, an empty one or one without words has no shingles, links with nothing and is its own
component; one with fewer than five words is a single shingle. Rows that repeat a doc_id are judged each by its own text. A
row with a null doc_id connects no others; its component is that of rows with the same set, or null. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import Workspace, batch, by_text, pack, parts_for, read_table, texts_of, unpack
from churnkit.llm.components import components
from churnkit.llm.registry import query
from churnkit.llm.words import Words, mix, split_words

SHINGLE = 5
RARE = 64
SMALL = 1_000_000
_PART_ROWS = 1000
_PART_TOKENS = 500_000
_BUCKET_TOKENS = 500_000
_SEVERAL = 0xFFFF
_SENT_BITS = 48
_WORDS = 8
_SOME_KEYS = 4
_U = np.uint64
_NONE = np.empty(0, _U)


class Threshold:
    """Similarity of at least num / den, in whole numbers."""

    def __init__(self, num: int = 75, den: int = 100):
        self.num, self.den = num, den

    def least_common(self, n: int) -> int:
        """Tokens that a set of n has in common with any set that it links with, at least."""
        return max(1, -(-self.num * n // self.den))

    def least_as_smaller(self, n: int) -> int:
        """Tokens that a set of n has in common with any set that is no smaller and that it links with, at least."""
        return max(1, -(-2 * self.num * n // (self.num + self.den)))

    def linked(self, common: int, n: int, m: int) -> bool:
        return self.den * common >= self.num * (n + m - common)

    def possible(self, n: int, m: int, differing: int) -> bool:
        """Whether sets of n and m that differ in ``differing`` tokens or more can link."""
        common = min(min(n, m), (n + m - differing) // 2)
        return common > 0 and self.linked(common, n, m)


def shingle_sets(texts: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """The set of each text: ascending hashes of its runs of ``size`` words in which A to Z are lower-cased."""
    words: Words = split_words([t.encode() for t in texts], lower=True)
    single = words.hashes()
    hashes, at = words.windows(size, single)
    edges = np.searchsorted(at, words.first)
    out = []
    for i, (a, b) in enumerate(zip(words.first.tolist(), words.first[1:].tolist())):
        if b - a >= size:
            out.append(np.unique(hashes[edges[i] : edges[i + 1]]))
        elif b > a:
            out.append(words._joined(single, np.array([a]), b - a))
        else:
            out.append(_NONE)
    return out


def class_of(tokens: np.ndarray) -> int:
    """A number for the set: 64 bits of a cryptographic hash."""
    return int.from_bytes(blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _each_set(b: pa.RecordBatch) -> Iterator[tuple[int | None, np.ndarray]]:
    for part in by_text(b, "text", 1 << 19):
        own = b.slice(part.start, part.stop - part.start)
        yield from zip(own.column("doc_id").to_pylist(), shingle_sets(texts_of(own.column("text"))))


def _classes(docs: DataFrame) -> DataFrame:
    """(doc_id, digest of the text, n, cls) of every row."""
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "digest", "n", "cls")])

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, sets = zip(*_each_set(b)) if b.num_rows else ((), ())
            classes = [class_of(t) if len(t) else None for t in sets]
            yield batch(schema, list(ids), b.column("digest"), [len(t) for t in sets], classes)

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("digest"))
    return rows.mapInArrow(classify, "doc_id long, digest long, n long, cls long")


def _bands(n: int, least: int) -> list[int]:
    """Size bands (powers of four) in which a set of n can meet a partner that is no larger, or of its own band."""
    own = (n.bit_length() - 1) // 2
    return [own] if least >= 4**own or own == 0 else [own, own - 1]


def _beginning(tokens: np.ndarray, n_rare: int, n: int, least: int, bands: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set of n for partners with ``least`` common tokens: rare tokens, and pairs of frequent ones.

    ``tokens`` are those that other sets have, in the global order; the others come before them. ``n_rare`` tokens of
    the set are rare.
    """
    alone = n - len(tokens)
    long = n - least + 1
    single = tokens[: max(0, min(long, n_rare) - alone)]
    pairs = [_NONE]
    if long > n_rare:
        frequent = tokens[n_rare - alone :]
        for band in bands:
            classes = max(1, 4 ** (band - 1)) if band else 1
            of = (mix(frequent) % _U(classes)).astype(np.int64)
            new = np.zeros(len(of), np.int64)
            new[np.unique(of, return_index=True)[1]] = 1
            seen = np.concatenate([np.zeros(n_rare, np.int64), np.cumsum(new)])  # classes among the first tokens
            # The beginning grows until it is longer than n - least by more than the classes in it.
            sizes = np.arange(long, n + 1)
            enough = seen[sizes - 1] <= sizes - (n - least) - 1
            end = int(sizes[np.argmax(enough)]) if enough.any() else n
            own, of = frequent[: end - n_rare], of[: end - n_rare]
            by = np.argsort(of, kind="stable")
            own, of = own[by], of[by]
            for step in range(1, len(own)):
                same = of[step:] == of[:-step]
                if not same.any():
                    break
                a, b = own[step:][same], own[:-step][same]
                with np.errstate(over="ignore"):
                    pairs.append(mix(np.minimum(a, b) * _U(0x9E3779B97F4A7C15) ^ mix(np.maximum(a, b))))
    return single, np.unique(np.concatenate(pairs))


def keys_of(
    tokens: np.ndarray, sets: np.ndarray, n: int, threshold: Threshold, rare: int, merged: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set of n and whether it has them as the smaller of two as well.

    ``tokens`` are those that several sets have, ``sets`` how many have each, both in the global order. A token that at
    most ``rare`` sets have is rare. Of the set's tokens ``merged`` fell together with another when they were shortened:
    so many fewer may be found in common.
    """
    shared, short = len(tokens), n - merged
    least = max(1, threshold.least_common(n) - merged)
    if shared < least:
        return _NONE, np.empty(0, bool)
    n_rare = short - shared + int(np.searchsorted(sets, rare, "right"))
    bands = _bands(n, threshold.least_common(n))
    large = np.concatenate(_beginning(tokens, n_rare, short, least, bands))
    least = max(1, threshold.least_as_smaller(n) - merged)
    if shared < least:
        return large, np.zeros(len(large), bool)
    small = np.concatenate(_beginning(tokens, n_rare, short, least, bands[:1]))
    return large, np.isin(large, small)


def sketch_of(tokens: np.ndarray) -> bytes:
    """Parities of tokens by their last bits, as many bits as the next power of two above their number, 64 * _WORDS or more."""
    bits = max(64 * _WORDS, 1 << len(tokens).bit_length())
    odd = np.bincount((tokens & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: bytes) -> list[int]:
    """The sketch as ``_WORDS`` numbers of 64 bits: halves of a longer one added up."""
    bits = np.frombuffer(sketch, "<i8")
    while len(bits) > _WORDS:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits.tolist()


def least_difference(x: bytes, y: bytes) -> int:
    """A number of tokens by which two sets differ at least: parities that disagree. Halves of a sketch add up to a shorter one."""
    x, y = (x, y) if len(x) <= len(y) else (y, x)
    number, size = int.from_bytes(y, "little"), 8 * len(y)
    while size > 8 * len(x):
        size //= 2
        number = (number >> size) ^ (number & ((1 << size) - 1))
    return (number ^ int.from_bytes(x, "little")).bit_count()


_SENT = (
    "part long, bucket long, tokens binary, own binary, counts binary, classes binary, sizes binary, merged binary, sketches array<binary>"
)


def _sent(docs: DataFrame, buckets: int) -> DataFrame:
    """What parts of the documents send: per bucket their tokens, and once what they need when the answers come.

    ``own`` has the number, within the part, of the one set that has a token, or ``_SEVERAL``; ``counts`` how many have it.
    The row without a bucket has the classes, sizes and sketches of the part's sets, and the tokens that several have
    with the numbers of these sets one after another. Tokens travel with ``_SENT_BITS`` bits; ``merged`` tells how many of a
    set's then fell together.
    """
    binary = [(c, pa.binary()) for c in ("tokens", "own", "counts", "classes", "sizes", "merged")]
    schema = pa.schema([("part", pa.int64()), ("bucket", pa.int64()), *binary, ("sketches", pa.list_(pa.binary()))])

    def rows_of(part: int, sets: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(t) for t in sets.values()], np.int64)
        short = [t >> _U(64 - _SENT_BITS) for t in sets.values()]  # still ascending
        short = [t[np.concatenate([[True], t[1:] != t[:-1]])] for t in short]
        left = np.array([len(t) for t in short], np.int64)
        tokens = np.concatenate(short)
        order = np.argsort(tokens, kind="stable")
        own = np.repeat(np.arange(len(sizes)), left)[order].astype("<u2")
        tokens, first, counts = np.unique(tokens[order], return_index=True, return_counts=True)
        several = counts > 1
        lists = np.repeat(several, counts)
        yield batch(
            schema, [part], [None], [pack(tokens[several])], [own[lists].tobytes()], [counts[several].astype("<u2").tobytes()],
            [np.array(list(sets), np.int64).tobytes()], [sizes.tobytes()], [(sizes - left).tobytes()],
            [[sketch_of(t) for t in sets.values()]],
        )
        one = np.where(several, _SEVERAL, own[first]).astype("<u2")
        counts = counts.astype("<u2")
        bucket = ((tokens >> _U(_SENT_BITS - 32)) * _U(buckets)) >> _U(32)
        edges = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(tokens)]
        spans = [slice(x, y) for x, y in zip(edges, edges[1:])]
        blank = [None] * len(spans)
        yield batch(
            schema, [part] * len(spans), [int(bucket[s.start]) for s in spans], [pack(tokens[s]) for s in spans],
            [one[s].tobytes() for s in spans], [counts[s].tobytes() for s in spans], blank, blank, blank, blank,
        )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 32
        sets: dict[int, np.ndarray] = {}
        held = 0
        for b in batches:
            for _, tokens in _each_set(b):
                if not len(tokens):
                    continue
                sets.setdefault(class_of(tokens), tokens)
                held += len(tokens)
                if len(sets) == _PART_ROWS or held > _PART_TOKENS:
                    yield from rows_of(part, sets)
                    part, sets, held = part + 1, {}, 0
        if sets:
            yield from rows_of(part, sets)

    return docs.select("doc_id", "text").mapInArrow(send, _SENT)


def _shared_tokens(sent: DataFrame) -> DataFrame:
    """The answers: per part and bucket the tokens that several sets have, and how many sets have each (``counts``)."""
    schema = pa.schema([("part", pa.int64()), ("tokens", pa.binary()), ("own", pa.binary()), ("counts", pa.binary())])

    def meet(rows: pa.Table) -> pa.Table:
        parts = rows.column("part").to_pylist()
        tokens = [unpack(x) for x in rows.column("tokens").to_pylist()]
        counts = np.concatenate([np.frombuffer(x, "<u2") for x in rows.column("counts").to_pylist()]).astype(np.int64)
        own = [np.frombuffer(x, "<u2") for x in rows.column("own").to_pylist()]
        whole = np.concatenate(tokens)
        order = np.argsort(whole, kind="stable")
        first = np.concatenate([[True], whole[order][1:] != whole[order][:-1]])
        sums = np.add.reduceat(counts[order], np.flatnonzero(first))
        total = np.empty(len(whole), np.int64)
        total[order] = sums[np.cumsum(first) - 1]
        out, at = [], 0
        for part, t, o in zip(parts, tokens, own):
            n = total[at : at + len(t)]
            at += len(t)
            some = n > 1
            if some.any():
                out.append((part, pack(t[some]), o[some].tobytes(), n[some].astype("<i8").tobytes()))
        return pa.Table.from_batches([batch(schema, *map(list, zip(*out)))] if out else [], schema=schema)

    dealt = sent.where("bucket is not null").select("bucket", "part", "tokens", "own", "counts")
    return dealt.groupBy("bucket").applyInArrow(meet, "part long, tokens binary, own binary, counts binary")


_KEYS = "sig long, cls long, n long, shared long, smaller boolean, sketch binary, words array<long>"


def _keys(sent: DataFrame, threshold: Threshold, rare: int) -> DataFrame:
    """Keys of all classes that can link; rows without sig carry their n and their sketches, of any and of fixed size."""
    schema = pa.schema([
        ("sig", pa.int64()), ("cls", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("smaller", pa.bool_()),
        ("sketch", pa.binary()), ("words", pa.list_(pa.int64())),
    ])

    def assemble(rows: pa.Table) -> pa.Table:
        own_rows = rows.column("classes").is_valid().to_pylist()
        own = rows.slice(own_rows.index(True), 1).to_pylist()[0]
        answers = rows.filter(pa.array([not x for x in own_rows]))
        classes, sizes, merged = (np.frombuffer(own[c], "<i8") for c in ("classes", "sizes", "merged"))
        of, tokens, sets = [np.empty(0, np.int64)], [_NONE], [np.empty(0, np.int64)]
        several, times = unpack(own["tokens"]), np.frombuffer(own["counts"], "<u2").astype(np.int64)
        lists, begin = np.frombuffer(own["own"], "<u2").astype(np.int64), np.cumsum(times) - times
        for t, o, n in zip(*(answers.column(c).to_pylist() for c in ("tokens", "own", "counts"))):
            t, o, n = unpack(t), np.frombuffer(o, "<u2").astype(np.int64), np.frombuffer(n, "<i8")
            one = o != _SEVERAL
            of.append(o[one])
            tokens.append(t[one])
            sets.append(n[one])
            at = np.searchsorted(several, t[~one])
            many = times[at]
            place = np.repeat(begin[at] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
            of.append(lists[place])
            tokens.append(np.repeat(t[~one], many))
            sets.append(np.repeat(n[~one], many))
        of, tokens, sets = (np.concatenate(x) for x in (of, tokens, sets))
        order = np.lexsort((tokens, sets, of))
        of, tokens, sets = of[order], tokens[order], sets[order]
        edges = np.searchsorted(of, np.arange(len(classes) + 1)).tolist()
        found, flags, times = [_NONE], [np.empty(0, bool)], np.zeros(len(classes), np.int64)
        for i, (a, b, n, fell) in enumerate(zip(edges, edges[1:], sizes.tolist(), merged.tolist())):
            sig, smaller = keys_of(tokens[a:b], sets[a:b], n, threshold, rare, fell)
            times[i] = len(sig)
            found.append(sig)
            flags.append(smaller)
        shared = np.diff(edges) + merged
        some = np.flatnonzero(times)
        sketches = [own["sketches"][i] for i in some.tolist()]
        blank = [None] * int(times.sum())
        rows_of = [np.repeat(x, times) for x in (classes, sizes, shared)]
        keys = batch(schema, np.concatenate(found).view(np.int64), *rows_of, np.concatenate(flags), blank, blank)
        blank = [None] * len(some)
        told = batch(schema, blank, classes[some], sizes[some], blank, blank, sketches, [folded(x) for x in sketches])
        return pa.Table.from_batches([keys, told]).combine_chunks()

    blank = [F.lit(None).cast(t).alias(c) for c, t in (("classes", "binary"), ("sizes", "binary"), ("merged", "binary"), ("sketches", "array<binary>"))]
    answers = _shared_tokens(sent).select("part", "tokens", "own", "counts", *blank)
    both = sent.where("bucket is null").drop("bucket").unionByName(answers)
    return both.groupBy("part").applyInArrow(assemble, _KEYS)


def _possible(threshold: Threshold) -> Column:
    """Whether the sets of a joined row can link by their sizes and by what each shares with any set."""
    near = F.greatest("na", "nb") * threshold.num <= F.least("na", "nb") * threshold.den
    most = F.least("sa", "sb") * (threshold.num + threshold.den)
    return near & (most >= (F.col("na") + F.col("nb")) * threshold.num) & (F.col("a") != F.col("b"))


def _alike(threshold: Threshold) -> Column:
    """Whether sets can link by their folded sketches: each parity that disagrees is a token of one of them alone."""
    differing = F.lit(0)
    for i in range(_WORDS):
        differing = differing + F.bit_count(F.col("wa")[i].bitwiseXOR(F.col("wb")[i]))
    both = F.col("na") + F.col("nb")
    return (both - differing) * (threshold.num + threshold.den) >= both * (2 * threshold.num)


def _side(keys: DataFrame, side: str) -> DataFrame:
    """sig, class, size and shared tokens, and label and sketch if there are any, named for one side of a pair."""
    names = {"cls": side, "n": f"n{side}", "shared": f"s{side}", "label": f"label_{side}", "words": f"w{side}"}
    return keys.select("sig", *[F.col(c).alias(n) for c, n in names.items() if c in keys.columns])


def _met(one: DataFrame, other: DataFrame, condition: Column) -> DataFrame:
    """Different pairs of classes that share a key and meet the condition."""
    joined = _side(one, "a").join(_side(other, "b").hint("merge"), "sig").where(condition)
    return joined.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _star_pairs(keys: DataFrame, threshold: Threshold) -> DataFrame:
    """Possible pairs of the classes of each key with the one that has fewest tokens of its own alone.

    Near copies are most like what they were copied from, and that shares nearly all it has.
    """
    hubs = keys.groupBy("sig").agg(F.min_by("cls", F.col("n") - F.col("shared")).alias("cls"))
    return _met(keys.join(hubs.hint("merge"), ["sig", "cls"]), keys, _possible(threshold))


def _thinned(pairs: DataFrame, sketches: DataFrame, threshold: Threshold) -> DataFrame:
    """Pairs whose sizes and sketches leave a link possible."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            columns = [x.column(c).to_pylist() for c in ("a", "b", "na", "nb", "sa", "sb")]
            left = [
                (a, b)
                for a, b, n, m, s, t in zip(*columns)
                if threshold.possible(n, m, 0) and threshold.possible(n, m, least_difference(s, t))
            ]
            yield batch(schema, [a for a, _ in left], [b for _, b in left])

    first = sketches.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    second = sketches.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(first.hint("merge"), "a").join(second.hint("merge"), "b")
    return both.mapInArrow(thin, "a long, b long")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= SMALL else df.hint("merge")


def _links(ws: Workspace, pairs: DataFrame, docs: DataFrame, firsts: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs that link, by their whole sets, which are formed anew from one document of each class."""
    schema = pa.schema([("cls", pa.int64()), ("tokens", pa.list_(pa.int64()))])
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    ids = ws.write(firsts.join(wanted.hint("merge"), "cls").select(F.col("first").alias("doc_id"), "cls"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            wanted = b.column("cls").to_pylist()
            found = [(c, t) for c, (_, t) in zip(wanted, _each_set(b)) if len(t) and class_of(t) == c]
            for i in range(0, len(found), 256):
                part = found[i : i + 256]
                yield batch(schema, [c for c, _ in part], [t.view(np.int64) for _, t in part])

    chosen = docs.select("doc_id", "text").join(_small(ids), "doc_id")
    formed = ws.write(chosen.mapInArrow(sets, "cls long, tokens array<long>").dropDuplicates(["cls"]))
    a = formed.select(F.col("cls").alias("a"), F.col("tokens").alias("x"))
    b = formed.select(F.col("cls").alias("b"), F.col("tokens").alias("y"))
    both = pairs.join(a.hint("merge"), "a").join(b.hint("merge"), "b")
    common = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - common
    links = ws.write(both.where(common * threshold.den >= union * threshold.num).select("a", "b"))
    ws.drop(ids, formed)
    return links


def near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links) of every row of docs."""
    return _judged(docs, **options).drop("digest", "root")


def _judged(docs: DataFrame, threshold: Threshold | None = None, rare: int = RARE) -> DataFrame:
    """doc_id, digest of the text, n_shingles, component_id and root, the least class of the component, of every row."""
    threshold = threshold or Threshold()
    ws = Workspace(docs.sparkSession)
    rows = ws.write(_classes(docs))
    named = rows.where("cls is not null and doc_id is not null")
    firsts = ws.write(named.groupBy("cls").agg(F.min("doc_id").alias("first"), F.min("n").alias("n")))
    # Of equal sets one takes part, and a row without an id brings none of its own to the comparison.
    others = ws.write(named.select("doc_id").distinct().join(firsts.hint("merge"), F.col("doc_id") == F.col("first"), "left_anti"))
    total = firsts.agg(F.sum("n").alias("n")).first().n or 0
    taking_part = docs.where("doc_id is not null").select("doc_id", "text").join(_small(others), "doc_id", "left_anti")
    sent = ws.write(_sent(taking_part, parts_for(total, _BUCKET_TOKENS)))
    keys = ws.write(_keys(sent, threshold, rare))
    ws.drop(sent, others)
    sigs = keys.where("sig is not null").drop("sketch", "words")
    met = sigs.groupBy("sig").agg(F.min("cls").alias("low"), F.max("cls").alias("high")).where("low <> high")
    sigs = ws.write(sigs.join(met.select("sig").hint("merge"), "sig", "left_semi"))
    sketches = keys.where("sig is null").select("cls", "n", "sketch", "words").dropDuplicates(["cls"])
    sketches = ws.write(sketches)
    ws.drop(keys)

    def compared(pairs: DataFrame) -> DataFrame:
        thin = ws.write(_thinned(pairs, sketches, threshold))
        found = pairs.limit(0) if thin.isEmpty() else _links(ws, thin, docs, firsts, threshold)
        ws.drop(thin)
        return found

    def open_keys(labels: DataFrame) -> DataFrame:
        """Keys whose classes are not all connected yet, with the labels of their classes."""
        joined = sigs.join(labels.select(F.col("node").alias("cls"), "root").hint("merge"), "cls", "left")
        joined = joined.withColumn("label", F.coalesce("root", "cls")).drop("root")
        apart = joined.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        return ws.write(joined.join(apart.select("sig").hint("merge"), "sig", "left_semi"))

    tried = ws.write(_star_pairs(sigs.where(F.pmod(F.xxhash64("sig"), F.lit(_SOME_KEYS)) == 0), threshold))
    links = compared(tried)
    labels = components(ws, links)
    rest = open_keys(labels)
    if not rest.isEmpty():
        rest = rest.join(sketches.select("cls", "words").hint("merge"), "cls")
        smaller = (F.col("na") <= F.col("nb")) & (F.col("label_a") != F.col("label_b"))
        pairs = _met(rest.where("smaller"), rest, smaller & _possible(threshold) & _alike(threshold))
        pairs = ws.write(pairs.join(tried.hint("merge"), ["a", "b"], "left_anti"))
        found = compared(pairs)
        if not found.isEmpty():
            labels = components(ws, links.union(found))

    roots = firsts.join(labels.select(F.col("node").alias("cls"), "root").hint("merge"), "cls", "left")
    roots = roots.withColumn("root", F.coalesce("root", "cls"))
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    of = roots.join(least.hint("merge"), "root").select("cls", "root", "component_id")
    done = rows.join(of.hint("merge"), "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return done.select("doc_id", "digest", F.col("n").alias("n_shingles"), component.alias("component_id"), "root")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """One row of each component, with all its columns, and all rows without a doc_id or without words.

    Each row is judged by its own text, also if its doc_id repeats: of a component stays the row of smallest doc_id, of
    several with that doc_id the one whose text has the least hash, of rows with that text as well any one.
    """
    ws = Workspace(docs.sparkSession)
    found = ws.write(_judged(docs, **options).where("doc_id is not null and n_shingles > 0").drop("n_shingles"))
    # A component is known by its root: unlike rows of one id are components of the same component_id.
    own = found.where("doc_id = component_id").groupBy("doc_id", "root")
    own = own.agg(F.min("digest").alias("least"), F.count("*").alias("m"))
    repeated = ws.write(own.where("m > 1"))
    other = found.where("doc_id <> component_id").select("doc_id", "digest")
    same = found.where("doc_id = component_id").join(_small(repeated), ["doc_id", "root"]).where("digest <> least")
    lost = _small(ws.write(other.union(same.select("doc_id", "digest")).distinct()))
    digest = F.xxhash64(docs["text"])
    kept = docs.join(lost, (docs["doc_id"] == lost["doc_id"]) & (digest == lost["digest"]), "left_anti")
    if repeated.isEmpty():
        return kept
    first = _small(repeated)
    is_one = (kept["doc_id"] == first["doc_id"]) & (F.xxhash64(kept["text"]) == first["least"])
    once = kept.join(first, is_one, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(first, is_one, "left_anti").unionByName(once)


_SQL = r"""
with recursive w as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents
), s as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as t
  from (select doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) as i from w where len(w) > 0)
), n as (
  select doc_id, count(*) as n from s group by doc_id
), link as (
  select a.doc_id as a, b.doc_id as b, any_value(x.n) as x, any_value(y.n) as y
  from s a join s b on a.t = b.t and a.doc_id <> b.doc_id
    join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id having 100 * count(*) >= 75 * (any_value(x.n) + any_value(y.n) - count(*))
), reach as (
  select doc_id as a, doc_id as b from n union select reach.a, link.b from reach join link on link.a = reach.b
), least as (
  select a as doc_id, min(b) as component_id from reach group by a
)
select w.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(component_id, w.doc_id) as component_id
from w left join n using (doc_id) left join least using (doc_id)
"""


@query(_SQL)
def op3_ngram_jaccard_join(spark, sf_dir):
    """Groups of documents linked by shingles of five words and a similarity of 0.75 or more."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))
