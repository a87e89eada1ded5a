import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from churnkit.llm.common import by_text, pack, unpack
from churnkit.llm.words import covered, split_words

TEXTS = st.lists(st.text(alphabet="ab é\n\t\x0b\x1c Z", max_size=40), max_size=6)


def reference(text, lower):
    if lower:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


@settings(deadline=None)
@given(TEXTS, st.booleans())
def test_words_are_those_of_the_pattern(texts, lower):
    words = split_words([t.encode() for t in texts], lower)
    raw = words.data.tobytes()
    for i, t in enumerate(texts):
        own = slice(words.first[i], words.first[i + 1])
        assert [raw[a:b].decode() for a, b in zip(words.start[own], words.end[own])] == reference(t, lower)


@settings(deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_windows_hash_alike_just_when_their_words_are_alike(texts, k):
    words = split_words([t.encode() for t in texts])
    hashes, at = words.windows(k)
    runs = [tuple(w[i : i + k]) for w in (reference(t, False) for t in texts) for i in range(len(w) - k + 1)]
    assert len(hashes) == len(runs) == len(at)
    assert len(set(zip(hashes.tolist(), runs))) == len(set(runs)) == len(set(hashes.tolist()))


def test_hashes_do_not_depend_on_the_place_in_the_block():
    texts = [b"x " * n + b"a long word" for n in (0, 1, 2_000_000)]
    words = split_words(texts)
    ends = [words.hashes()[words.first[i + 1] - 1] for i in range(3)]
    assert len(set(map(int, ends))) == 1


@given(st.lists(st.integers(0, 2**64 - 1)))
def test_packing_is_undone(values):
    values = np.sort(np.array(values, np.uint64))
    assert (unpack(pack(values)) == values).all()


@given(st.sets(st.integers(0, 20)), st.integers(1, 5))
def test_covered(starts, k):
    n = 26
    expected = Counter(i for s in starts for i in range(s, s + k))
    assert covered(np.array(sorted(starts), np.int64), k, n).tolist() == [i in expected for i in range(n)]


@pytest.mark.parametrize("limit", [1, 7, 1000])
def test_slices_cover_a_batch_once(limit):
    import pyarrow as pa

    b = pa.record_batch({"text": ["aaa", None, "", "b" * 50, "cc"]})
    assert [i for s in by_text(b, "text", limit) for i in range(s.start, s.stop)] == list(range(5))


def thue_morse(n, first, second):
    return "".join((first, second)[bin(i).count("1") & 1] for i in range(n))


@pytest.mark.parametrize("size", [257, 1024, 2048, 4096])
def test_long_words_that_agree_in_polynomials_are_told_apart(size):
    words = [thue_morse(size, "a", "b"), thue_morse(size, "b", "a"), thue_morse(size, "a", "b")]
    a, b, c = split_words([" ".join(words).encode()]).hashes().tolist()
    assert a != b and a == c
