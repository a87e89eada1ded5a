"""Exact copies against brute force: collisions, repeated and missing ids, full buckets and hot texts."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from churnkit.llm.exact_dedup import Directory, dedup_exact, drop_copies
from tests.llm.samples import some_rows, table


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[low(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        first = ids.index(keep)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), k == first, digest) for k, i in enumerate(ids)]
    return sorted(out, key=str)


def more_rows():
    rows = some_rows()
    rows += [(1000 + i, "A text That Many rows have") for i in range(200)] + [(900, "a text that many rows have")] * 3
    rows += [(None, "a text that many rows have"), (None, "no id"), (None, "NO id"), (None, "ÀB"), (4000, "àb"), (4001, "Àb")]
    return rows


@pytest.mark.parametrize("capacity,hash_bits,part_rows", [(32 << 20, 64, 8192), (300, 64, 5), (300, 3, 7), (1 << 20, 1, 1), (200, 0, 20)])
def test_groups_are_those_of_equal_texts(spark, capacity, hash_bits, part_rows):
    """Few bits of the hash put unlike texts into one chain, small parts put one text into many entries."""
    rows = more_rows()
    found = dedup_exact(table(spark, rows), capacity=capacity, hash_bits=hash_bits, part_rows=part_rows).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found), key=str) == expected(rows)


def test_rows_that_stay_have_all_their_columns(spark):
    docs = table(spark, more_rows())
    kept = drop_copies(docs, part_rows=50)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    found = sorted(((r.doc_id, low(r.text)) for r in kept.collect()), key=str)
    by_digest = {hashlib.sha256(low(t).encode()).hexdigest(): low(t) for _, t in more_rows()}
    assert found == sorted(((d, by_digest[h]) for d, _, _, k, h in expected(more_rows()) if k), key=str)


def test_no_documents(spark):
    empty = table(spark, [(1, "a")]).where("doc_id = 2")
    assert dedup_exact(empty).collect() == [] and drop_copies(empty).collect() == []


def test_an_overfull_bucket_is_split_until_it_fits():
    rng = np.random.default_rng(1)
    load = rng.integers(0, 100, 256)
    load[200:204] = 5000
    keys = (load > 0) * 2
    directory = Directory(load, keys, 600)
    slots = np.repeat(directory.slots, 256 >> directory.depth)
    assert len(directory.slots) == 1 << directory.depth and directory.depth == max(directory.local)
    for bucket, deep in enumerate(directory.local):
        own = np.flatnonzero(slots == bucket)
        assert len(own) == 256 >> deep and (np.diff(own) == 1).all()
        assert load[own].sum() <= 600 or deep == 8
    assert Directory(np.zeros(4, np.int64), np.zeros(4, np.int64), 10).slots == [0]
