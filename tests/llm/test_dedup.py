"""Near duplicates, lines, passages and benchmark leaks against brute force on the small samples."""

import hashlib
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnkit.llm import near_duplicates as near
from churnkit.llm.common import Workspace
from churnkit.llm.components import components
from churnkit.llm.decontaminate import drop_leaks, leak_report
from churnkit.llm.line_dedup import dedup_lines, line_key
from churnkit.llm.substring_dedup import remove_repeats
from tests.llm.samples import LINE, PASSAGE, some_rows, table


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def rows():
    return some_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return table(spark, rows)


@pytest.fixture
def empty(spark):
    return table(spark, [(1, "a")]).where("doc_id = 2")


# ---- near duplicates -------------------------------------------------------------------------------------------


def shingles(text):
    words = split(low(text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def linked_groups(rows):
    """The rows' sets, and the number of the group that each row belongs to."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if None in (rows[i][0], rows[j][0]) and sets[i] != sets[j]:
            continue  # a row without an id connects no others
        if both and 100 * both >= 75 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    return sets, [find(i) for i in range(len(rows))]


def expected_components(rows):
    sets, group = linked_groups(rows)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None and sets[i]:
            least[group[i]].append(doc_id)
    return sorted(
        ((d, len(s), min(least[group[i]], default=None) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str
    )


def expected_single(spark, rows):
    """One row of each group: the least doc_id, then the least hash of the text; and rows without an id or words."""
    texts = sorted({t for _, t in rows if t is not None})
    hashed = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("h"))
    digest = {r.t: r.h for r in hashed.collect()}
    sets, group = linked_groups(rows)
    kept, first = [], {}
    for i, (doc_id, text) in enumerate(rows):
        if doc_id is None or not sets[i]:
            kept.append((doc_id, text))
        else:
            own = (doc_id, digest[text], text)
            first[group[i]] = min(first.get(group[i], own), own)
    return sorted(kept + [(d, t) for d, _, t in first.values()], key=str)


@pytest.mark.parametrize("rare,part", [(64, 2000), (3, 5), (1, 13)])
def test_components_are_those_of_all_pairs(docs, rows, rare, part, monkeypatch):
    """Few rare tokens make pairs of frequent ones the keys; in small parts most tokens are counted across parts."""
    monkeypatch.setattr(near, "_PART_ROWS", part)
    found = near.near_duplicates(docs, rare=rare).collect()
    assert sorted((tuple(r) for r in found), key=str) == expected_components(rows)


def test_a_large_group_of_near_copies_is_one_component(spark):
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(base[:k] + [f"new{i}"] + base[k + 1 :])) for i in range(300) for k in [i % 100]]
    rows += [(1000 + i, " ".join(f"other{i}x{j}" for j in range(20))) for i in range(50)]
    assert sorted(tuple(r) for r in near.near_duplicates(table(spark, rows)).collect()) == sorted(expected_components(rows))


def test_one_of_each_group_stays_with_all_its_columns(docs, rows):
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == expected_single(docs.sparkSession, rows)


def test_rows_of_one_id_are_judged_each_by_its_own_text(spark):
    a = " ".join(f"a{i}" for i in range(40))
    b = " ".join(f"b{i}" for i in range(40))
    near_b, c, near_c = b + " more", " ".join(f"c{i}" for i in range(40)), " ".join(f"c{i}" for i in range(39))
    rows = [(3, b), (5, a), (5, near_b), (7, c), (7, near_c), (7, near_c), (8, ""), (8, ""), (8, a + " and more"), (None, a), (None, a)]
    kept = sorted(((r.doc_id, r.text) for r in near.keep_one(table(spark, rows)).collect()), key=str)
    assert kept == expected_single(spark, rows)
    assert (5, a) in kept and (5, near_b) not in kept and len([d for d, _ in kept if d == 7]) == 1


def test_no_documents(empty):
    assert near.near_duplicates(empty).collect() == []
    assert near.keep_one(empty).collect() == []


def test_a_passage_in_many_unlike_documents_links_none_of_them(spark):
    """Nearly three quarters of each text are the same passage, and still they are not alike enough, but for a few."""
    passage = " ".join(f"shared{j}" for j in range(80))
    rows = [(i, passage + " " + " ".join(f"own{i}x{j}" for j in range(30 + i % 3))) for i in range(150)]
    rows += [(200 + i, " ".join(f"base{j}" for j in range(90)) + f" tail{i}") for i in range(150)]
    rows += [(400 + i, passage + f" end{i}") for i in range(20)] + [(500, passage), (501, passage + " " + " ".join(f"u{j}" for j in range(12)))]
    found = near.near_duplicates(table(spark, rows)).collect()
    assert sorted(tuple(r) for r in found) == sorted(expected_components(rows))
    assert len({r.component_id for r in found}) == 152


TOKENS = st.sets(st.integers(0, 60), min_size=1, max_size=40)


@settings(max_examples=300, deadline=None)
@given(TOKENS, st.sets(st.integers(0, 60), max_size=6), st.data())
def test_linked_sets_share_a_key_whatever_tokens_are_frequent(x, change, data):
    y = x ^ change
    limit = near.Threshold()
    if not y or x == y or not limit.linked(len(x & y), len(x), len(y)):
        return
    # How many sets have a token: one if only this one has it, any number from two if other sets may.
    sets = {t: data.draw(st.integers(2, 5)) if t in x & y else data.draw(st.integers(1, 5)) for t in x | y}
    keys = []
    for s in sorted((x, y), key=len):
        tokens = near.mix(np.array(sorted(s), np.uint64))
        count = np.array([sets[t] for t in sorted(s)])
        order = np.lexsort((tokens, count))
        order = order[count[order] > 1]
        tokens, count = tokens[order], count[order]
        found, smaller = near.keys_of(tokens, count, len(s), limit, 3)
        keys.append((set(found[smaller].tolist()), set(found.tolist())))
    assert keys[0][0] & keys[1][1]
    if len(x) == len(y):
        assert keys[1][0] & keys[0][1]


@settings(deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=400), st.sets(st.integers(0, 2**64 - 1), max_size=20))
def test_sketches_never_tell_sets_apart_more_than_they_are(x, change):
    a, b = (np.array(sorted(s), np.uint64) for s in (x, x ^ change))
    assert near.least_difference(near.sketch_of(a), near.sketch_of(b)) <= len(change)
    x, y = (np.array(near.folded(near.sketch_of(t))) for t in (a, b))
    assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= len(change)


def test_tokens_that_fall_together_when_sent_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near, "_SENT_BITS", 34)
    monkeypatch.setattr(near, "shingle_sets", crowded_sets)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[:k] + [f"new{i}"] + base[k + 1 :])) for i in range(60) for k in [i * 7 % 60]]
    assert len({r.component_id for r in near.near_duplicates(table(spark, rows)).collect()}) == 1


def crowded_sets(texts, size=5):
    """Token hashes of which many agree in their first 34 bits."""
    out = []
    for text in texts:
        words = split(low(text))
        runs = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}
        hashes = [int.from_bytes(hashlib.blake2b(repr(r).encode(), digest_size=8).digest(), "little") for r in runs]
        out.append(np.unique(np.array([h % 40 << 57 | h % (1 << 28) for h in hashes], np.uint64)))
    return out


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 105), (105, 103)]
    found = components(Workspace(spark), spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r.node, r.root) for r in found} == {(i, 0) for i in range(61)} | {(100, 100), (103, 100), (105, 100)}


# ---- lines -----------------------------------------------------------------------------------------------------


def expected_lines(rows):
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(line_key(line)) >= 40 and doc_id is not None:
                holders[line_key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if doc_id is None or len(h := holders.get(line_key(x), ())) < 5 or doc_id == max(h)]
        out.append((doc_id, len(lines), len(lines) - len(left), None if text is None else "\n".join(left)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bits", [18, 20])
def test_shared_lines_stay_in_one_document(docs, rows, bits):
    found = dedup_lines(docs, filter_bits=bits).select("doc_id", "n_lines", "n_dropped", "text").collect()
    assert sorted((tuple(r) for r in found), key=str) == expected_lines(rows)
    assert any(r.n_dropped for r in found)


def test_a_full_filter_changes_nothing(spark):
    """Far more keys than the filter has bits for: all are suspected, and counted exactly."""
    rows = [(i, "\n".join(f"{i} {j} this line is long enough and has no copy anywhere" for j in range(900))) for i in range(80)]
    rows += [(i, LINE) for i in range(100, 104)]
    assert {r.n_dropped for r in dedup_lines(table(spark, rows), filter_bits=18).collect()} == {0}
    rows.append((104, LINE))
    assert sum(r.n_dropped for r in dedup_lines(table(spark, rows), filter_bits=18).collect()) == 4


def test_rows_pass_through(docs, empty):
    found = dedup_lines(docs, with_row=True)
    assert found.select("row.*").columns == docs.columns
    assert dedup_lines(empty).collect() == []


# ---- passages --------------------------------------------------------------------------------------------------


def expected_passages(rows, size=13):
    first = {}
    for doc_id, text in rows:
        words = split(text)
        for i in range(len(words) - size + 1):
            if doc_id is not None:
                key = tuple(words[i : i + size])
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        words = split(text)
        gone = set()
        for i in range(len(words) - size + 1):
            if doc_id is not None and first[tuple(words[i : i + size])] < doc_id:
                gone.update(range(i, i + size))
        out.append((doc_id, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk,bucket", [(8 << 20, 12 << 20), (2000, 30_000)])
def test_repeated_passages_stay_in_the_first_document(docs, rows, chunk, bucket):
    found = remove_repeats(docs, chunk, bucket).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in found), key=str) == expected_passages(rows)
    for r in found:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_long_words_and_rows_without_ids_in_many_chunks(spark):
    def morse(i, first, second):
        return "".join((first, second)[bin(k).count("1") & 1] for k in range(1024 + i))

    rows = [(1, " ".join(morse(i, "a", "b") for i in range(13))), (2, " ".join(morse(i, "b", "a") for i in range(13)))]
    rows += [(None, PASSAGE)] * 40 + [(7, PASSAGE), (8, PASSAGE), (8, "more " + PASSAGE), (8, PASSAGE)]
    found = remove_repeats(table(spark, rows), 500, 3000).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.text) for r in found), key=str) == expected_passages(rows)


def test_no_passages(empty):
    assert remove_repeats(empty).collect() == []


# ---- benchmark -------------------------------------------------------------------------------------------------


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def expected_leaks(rows, items):
    windows = defaultdict(set)
    for item_id, text in items:
        words = bench_words(text)
        if item_id is not None and words:
            m = min(10, len(words))
            for i in range(len(words) - m + 1):
                windows[tuple(words[i : i + m])].add(item_id)
    out = []
    for doc_id, text in rows:
        words, hit, found = bench_words(text), set(), set()
        for m in {len(w) for w in windows}:
            for i in range(len(words) - m + 1):
                if tuple(words[i : i + m]) in windows:
                    hit.update(range(i, i + m))
                    found |= windows[tuple(words[i : i + m])]
        names = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEMS = [(10, PASSAGE), (9, "pass3, AGE3; pass4"), (8, "One two"), (7, None), (6, " - "), (None, "three four")]
ITEMS += [(11, " ".join(PASSAGE.split()[20:31])), (12, "nowhere to be found at all, not in any of these texts"), (12, "x")]
ITEMS += [(13, " ".join(PASSAGE.split()[:11])), (13, " ".join(PASSAGE.split()[:11]))]


@pytest.mark.parametrize("items", [ITEMS, [], [i for i in ITEMS if len(i[1] or "") > 60]])
def test_leaks_are_those_of_all_windows(spark, docs, rows, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = leak_report(docs, bench).collect()
    assert sorted((tuple(r) for r in found), key=str) == expected_leaks(rows, items)
    kept = drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    clean = sorted(r[0] for r in expected_leaks(rows, items) if not r[5] and r[0] is not None)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == clean


def test_no_texts_to_check(spark, empty):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert leak_report(empty, bench).collect() == []
    assert drop_leaks(empty, bench).collect() == []
