"""Spelling variants against brute force, and the pieces that the search relies on."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from churnkit.llm import variants
from tests.llm.samples import table

LETTERS = "abcdefgéÀz"


def counted(rows):
    found = Counter()
    for doc_id, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", lower):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            found[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(rows):
    count = counted(rows)
    near = {w: [v for v in count if is_near(w, v)] for w in count}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= 10 * count[w] else None
    out = []
    for w in count:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, count[w], len(near[w]), count.get(form[w])))
    return sorted(out, key=str)


def some_texts(seed=3):
    rng = random.Random(seed)
    bases = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(7, 12))) for _ in range(60)]

    def changed(w):
        i = rng.randrange(len(w))
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(LETTERS) + w[i:], w[:i] + rng.choice(LETTERS) + w[i + 1 :]])

    words = []
    for rank, b in enumerate(bases):
        words += [b] * (400 // (rank + 1))
        for _ in range(12):
            c = changed(b)
            words += [c] * rng.choice([1, 2, 3, 30])
            words += [changed(c)] * 2
    words += ["anagramz", "gramanaz"] * 3 + ["Upper" + "CASE"] * 3 + ["ÀÉÎÕÜÿþ", "àÉÎÕÜÿþ"] * 2 + ["x" * 3000, "x" * 2999 + "y"] * 2
    rng.shuffle(words)
    rows = [(i, " ".join(words[i::50]) + rng.choice([",", "1", "\n", "×÷"])) for i in range(50)]
    return rows + [(None, " ".join(words[:200])), (7, None), (8, ""), (9, " 12 -- "), (3, rows[3][1]), (3, rows[3][1]), (4, "a" * 50_000)]


@pytest.mark.parametrize("tile,bucket", [(20_000, 60_000), (7, 50), (1, 500)])
def test_variants_are_those_of_all_pairs(spark, tile, bucket):
    rows = some_texts()
    found = variants.group_variants(table(spark, rows), tile=tile, bucket=bucket).collect()
    assert sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found), key=str) == expected(rows)
    assert any(r.form and r.root != r.form for r in found) and any(r.n_near > 3 for r in found)


def test_one_block_that_holds_nearly_all_words(spark):
    """Words of the same letters but for the last: every choice of letter sets puts most of them together."""
    rows = [(i, " ".join(f"abcdefg{'hijklmno'[j]}{'pqrst'[i % 5]}" for j in range(8))) for i in range(40)]
    found = variants.group_variants(table(spark, rows), tile=3, bucket=20).collect()
    assert sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found), key=str) == expected(rows)


def test_no_words(spark):
    for rows in ([(1, "a")], [(1, None)]):
        assert variants.group_variants(table(spark, rows)).collect() == []
    assert variants.group_variants(table(spark, [(1, "a")]).where("doc_id = 2")).collect() == []


WORD = st.text(alphabet=LETTERS, min_size=1, max_size=9)


@settings(max_examples=300, deadline=None)
@given(st.lists(WORD, min_size=2, max_size=8, unique=True))
def test_edits_are_told_apart(words):
    words.sort(key=len)
    v = variants.Vectors(words)
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            if len(a) <= len(b) <= len(a) + 1 and a != b:
                assert v.one_edit(np.array([i]), np.array([j]))[0] == is_near(a, b)


@settings(max_examples=200, deadline=None)
@given(WORD, st.integers(0, 8), st.sampled_from(LETTERS), st.booleans())
def test_near_words_agree_in_some_choice_of_letter_sets(word, at, letter, replace):
    at %= len(word)
    other = word[:at] + letter + word[at + replace :]
    s = variants.Vectors([word, other]).signatures()
    assert (s[:, 0] == s[:, 1]).any()
    x = variants.Vectors([word, other]).counts()
    if word != other:
        assert ((x[0] - x[1]) ** 2).sum() == (2 if replace else 1)
