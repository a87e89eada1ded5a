"""Token counts, packing and quality rules."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer, models, pre_tokenizers

import public_tokenizers
from churnkit.llm import packing, quality_rules
from churnkit.llm.token_counts import Counter as TokenCounter
from churnkit.llm.token_counts import count_tokens, vocabulary
from tests.llm.samples import some_rows, table


@pytest.fixture(scope="module")
def rows():
    return some_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return table(spark, rows)


@pytest.fixture
def empty(spark):
    return table(spark, [(1, "a")]).where("doc_id = 2")


# ---- token counts ----------------------------------------------------------------------------------------------


def unigram(pieces):
    """The tokenizer itself, with an unknown piece in front."""
    low = min(pieces.values())
    tokenizer = Tokenizer(models.Unigram([("<none>", low), *pieces.items()], unk_id=0))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    return tokenizer


SMALL = {"▁": -3.0, "a": -2.0, "b": -2.0, "ab": -4.0, "ba": -4.0, "▁a": -5.0, "aba": -6.0, "▁ab": -5.0, "é": -9.0, "bb": -4.0}


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab é▁\nz", max_size=25))
def test_counts_follow_the_tie_rules(text):
    assert TokenCounter(SMALL).text(text) == len(unigram(SMALL).encode(text).ids)


def test_counts_of_the_vocabulary_are_those_of_the_tokenizer(docs, rows):
    tokenizer = unigram(vocabulary())
    found = {(r.doc_id, r.n_chars, r.n_tokens) for r in count_tokens(docs).collect()}
    wanted = {(i, None, None) if t is None else (i, len(t), len(tokenizer.encode(t).ids)) for i, t in rows}
    assert found == wanted


def test_forgetting_words_changes_nothing():
    counter, small = TokenCounter(SMALL), TokenCounter(SMALL, memory=2)
    for text in ("ab ba abba", "abab ab", "ba z ab bb") * 2:
        assert counter.text(text) == small.text(text)


def test_no_texts(empty):
    assert count_tokens(empty).collect() == []
    assert packing.pack(empty).collect() == []
    assert quality_rules.judge(empty).collect() == []


# ---- packing ---------------------------------------------------------------------------------------------------


def test_names_of_added_tokens_are_their_ids():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    names = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    assert names
    for name in names:
        for text in (name, f"a{name}b", f"a {name} {name}", f" {name}\n", name[:-1], name.upper()):
            assert packing.encoder()(text) == tokenizer.encode(text, add_special_tokens=False).ids
    assert packing.encoder()("a<|endoftext|>b") == [64, 50256, 65]


@pytest.mark.parametrize("capacity", [64, 2048])
def test_pieces_fill_sequences_without_gaps(spark, rows, capacity):
    rows = [*rows, (800, "one<|endoftext|> two <|endoftext|>"), (801, "<|endoftext|>" * 70), (802, "<|endoftext")]
    docs = table(spark, rows)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = packing.pack(docs, capacity).collect()
    wanted = Counter()
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        head = len(ids) % capacity if len(ids) > capacity else len(ids)
        starts = [0] * (head > 0) + list(range(head, len(ids), capacity))
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
            wanted[doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == wanted
    by = {}
    for r in found:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=2, max_size=40))
def test_a_plan_takes_every_piece_once(counts):
    counts = np.array([0, *counts])
    plan = packing.packing_plan(counts)
    used = np.zeros_like(counts)
    for n, lengths in plan:
        assert sum(lengths) < len(counts) and n > 0
        for v in lengths:
            used[v] += n
    assert (used == counts).all()


def test_mixed_lengths_pack_close_to_the_bound():
    rng = np.random.default_rng(3)
    counts = np.bincount(np.clip(rng.lognormal(6, 1, 50_000).astype(int), 1, 2048), minlength=2049)
    bound = -(-int((counts * np.arange(2049)).sum()) // 2048)
    assert sum(n for n, _ in packing.packing_plan(counts)) <= 1.005 * bound


def test_exact_fits_are_fitted():
    counts = np.zeros(101, np.int64)
    counts[[70, 30, 50, 25]] = [500, 500, 100, 200]
    assert sum(n for n, _ in packing.packing_plan(counts)) == 500 + 100


# ---- quality rules ---------------------------------------------------------------------------------------------


def counted(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {i + j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(8)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(hit), failed


def test_counts_and_limits(spark, rows):
    extra = [(900, "# a|b\n\n# a|b\n \n# a|b\n# a|b "), (901, "a b c d e f g h " * 2 + "z " * 9), (902, "w x y z " * 30)]
    found = quality_rules.judge(table(spark, rows + extra)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in found) == Counter((i, *counted(t)) for i, t in rows + extra)
    assert all(not r.kept for r in found if r.base_failed)


def prose(rng, n):
    return " ".join("".join(rng.choice(list("aeinrst"), rng.integers(2, 9))) for _ in range(n)) + "."


def test_outliers_go_and_the_rest_stays(spark):
    rng = np.random.default_rng(1)
    rows = [(i, prose(rng, int(rng.integers(30, 300)))) for i in range(1200)]
    junk = [(5000 + i, " ".join(w + "###" for w in prose(rng, 60).split())) for i in range(60)]
    junk += [(6000 + i, prose(rng, 60).upper().replace(" ", "!! ")) for i in range(60)]
    docs = table(spark, rows + junk)
    found = {r.doc_id: r for r in quality_rules.judge(docs, min_rows=100).collect()}
    assert all(found[i].kept for i, _ in rows)
    assert not any(found[i].kept for i, _ in junk)
    left = quality_rules.filter_quality(docs, min_rows=100)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {i for i, _ in rows}
    few = {r.doc_id: r for r in quality_rules.judge(docs, min_rows=5000).collect()}
    assert all(r.kept and r.distance is None for i, r in few.items())


def test_tables_and_navigation_of_pipes_go(spark):
    rng = np.random.default_rng(4)
    rows = [(i, prose(rng, int(rng.integers(30, 300)))) for i in range(1200)]
    pipes = [(5000 + i, " | ".join(prose(rng, 60)[:-1].split())) for i in range(60)]
    found = {r.doc_id: r for r in quality_rules.judge(table(spark, rows + pipes)).collect()}
    assert not any(found[i].kept for i, _ in pipes)
    assert sum(not found[i].kept for i, _ in rows) <= 2
    assert not any(found[i].base_failed for i, _ in pipes)


def test_small_groups_and_tables_are_judged(spark):
    rng = np.random.default_rng(6)

    def docs(rows):
        return spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")

    def pages(first, n, *group):
        return [(first + i, *group, prose(rng, 100)) for i in range(n)]

    def pipes(first, n, *group):
        return [(first + i, *group, " | ".join(prose(rng, 60)[:-1].split())) for i in range(n)]

    large = pages(0, 400, "en", "a") + pages(1000, 400, "de", "a")
    # A small source of a large language, a rare language, and a null language.
    groups = [("en", "b"), ("xx", "a"), (None, None)]
    small = [p for k, g in enumerate(groups) for p in pages(2000 + 100 * k, 20, *g)]
    junk = [p for k, g in enumerate(groups) for p in pipes(5000 + 100 * k, 5, *g)]
    for good, bad in ((large + small, junk), (pages(0, 60, "en", "a"), pipes(5000, 5, "en", "a"))):
        found = {r.doc_id: r for r in quality_rules.judge(docs(good + bad)).collect()}
        assert all(r.distance is not None for r in found.values())
        assert not any(found[r[0]].kept for r in bad)
        assert sum(not found[r[0]].kept for r in good) <= len(good) // 100
    single = quality_rules.judge(docs(pages(0, 2, "en", "a"))).collect()
    assert all(r.kept and r.distance is not None for r in single)


def test_the_cutoff_is_the_chi_square_quantile():
    assert quality_rules.chi_square_cutoff(0.001, 6) == pytest.approx(22.458, abs=1e-3)
    assert quality_rules.chi_square_cutoff(0.05, 2) == pytest.approx(5.991, abs=1e-3)


def test_one_step_matches_a_direct_estimate(spark):
    """A concentration step against numpy, with the core taken by whole bins."""
    rng = np.random.default_rng(2)
    names = quality_rules._VECTOR
    x = np.round(rng.multivariate_normal(np.zeros(6), np.diag([4, 1, 1, 2, 1, 9.0]), 3000) * 1000).astype(int)
    rows = spark.createDataFrame([("g", *map(int, r)) for r in x], ["grp", *names])
    start = quality_rules._start(rows)
    first = start.collect()[0]
    step = quality_rules._concentrate(rows, start, 0.75).collect()[0]
    away = x / 1000 - np.array(first.centre)
    precision = np.array(first.precision).reshape(6, 6)
    distance = np.einsum("ni,ij,nj->n", away, precision, away)
    bins = np.floor(np.log2(distance + 0.01) * 8)
    order = np.sort(bins)
    inside = x[bins <= order[int(np.ceil(0.75 * len(x))) - 1]] / 1000
    wide = np.cov(inside.T) * quality_rules._consistency(0.75, 6) + np.diag(np.square(quality_rules._FLOOR))
    assert np.allclose(step.centre, inside.mean(0))
    assert np.allclose(np.array(step.precision).reshape(6, 6), np.linalg.inv(wide))
    assert np.allclose(np.diag(wide), [4, 1, 1, 2, 1, 9.0], rtol=0.25)
