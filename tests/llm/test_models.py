"""The two classifiers: their arithmetic, their held-out accuracy, and the defined cases."""

import time
import zlib
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnkit.llm import quality_model, toxicity
from churnkit.llm.common import read_table
from churnkit.llm.training import labelled_sample
from tests.llm.samples import some_rows, table
from tests.oracle import DATA

SF = f"{DATA}/sf0.1"


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i * 7 % 101, int(i % 6 != 4), int(i % 6 == 3)) for i in range(60)] + [(500, 0, 0), (None, 1, 1), (1, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


SCORERS = [(quality_model.score_quality, 5, 0), (toxicity.score_toxicity, 3, 1)]


@pytest.mark.parametrize("score,folds,held", SCORERS)
def test_every_row_is_scored(spark, labels, score, folds, held):
    rows = some_rows()
    found = score(table(spark, rows), labels).collect()
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(str(i) for i, _ in rows)
    for r in found:
        assert 0 <= r.score <= 1
        wanted = None if r.doc_id is None else zlib.crc32(str(r.doc_id).encode()) % folds == held
        assert r.held_out == wanted


@pytest.mark.parametrize("score,folds,held", SCORERS)
def test_without_labels_or_documents(spark, labels, score, folds, held):
    docs = table(spark, some_rows())
    assert score(docs.where("doc_id = -99"), labels).collect() == []
    assert {round(r.score, 6) for r in score(docs, labels.where("doc_id = -99")).collect()} == {0.5}


@pytest.mark.parametrize("score,folds,held", SCORERS)
def test_labels_of_the_held_fold_and_other_columns_change_nothing(spark, labels, score, folds, held):
    rows = some_rows()
    docs = table(spark, rows)
    flip = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held
    flipped = labels.withColumns({c: F.when(flip, 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")})
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    first, second = ({r.doc_id: r.score for r in score(d, x).collect()} for d, x in ((docs, labels), (other, flipped)))
    assert first == second


@pytest.mark.parametrize(
    "score,label,folds,held,cut,least",
    [(quality_model.score_quality, "quality", 5, 0, 0.3, 0.99), (toxicity.score_toxicity, "toxic", 3, 1, 0.7, 0.93)],
)
def test_held_out_accuracy(spark, score, label, folds, held, cut, least):
    labels = read_table(spark, SF, "labels")
    known = {r.doc_id: r[label] for r in labels.collect()}
    found = [r for r in score(read_table(spark, SF, "documents"), labels).collect() if r.held_out and r.doc_id in known]
    right = sum((r.score >= cut) == bool(known[r.doc_id]) for r in found)
    assert len(found) > 500 and right / len(found) >= least


def test_the_identity_of_the_factorisation_machine():
    rng = np.random.default_rng(0)
    m = quality_model.Machine(6, 3)
    m.w, m.v, m.bias = rng.normal(size=6).astype("f4"), rng.normal(size=(6, 3)).astype("f4"), np.float32(0.3)
    x = rng.normal(size=(4, 6)).astype("f4")
    pairs = [m.bias + r @ m.w + sum(m.v[i] @ m.v[j] * r[i] * r[j] for i, j in combinations(range(6), 2)) for r in x]
    assert np.allclose(m.margin(x), pairs, atol=1e-4)


def test_gradients_lead_downhill():
    rng = np.random.default_rng(0)
    x = rng.random((400, 8)).astype("f4")
    y = (x[:, 0] * x[:, 1] > 0.25).astype("f4")
    m = quality_model.Machine(8).fit(x, y, rounds=200)
    assert ((m.score(x) > 0.5) == y).mean() > 0.95


WORD = st.text(alphabet="abcd", min_size=1, max_size=7)


def product(x, y):
    a, b = toxicity.features(x), toxicity.features(y)
    return sum(w * b.get(k, 0.0) for k, w in a.items())


@settings(deadline=None)
@given(st.lists(WORD, min_size=1, max_size=5), WORD)
def test_the_kernel_is_the_product_of_all_subsequences(words, z):
    block = toxicity.codes(words, -1)
    right = np.repeat(toxicity.codes([z], -2), len(words), axis=0)
    found, norms = toxicity.kernel(block, right), toxicity.prefix_norms(block)
    for i, w in enumerate(words):
        for a in range(len(w)):
            assert found[a, i] == pytest.approx(product(w[: a + 1], z), abs=1e-4)
            assert norms[a, i] == pytest.approx(product(w[: a + 1], w[: a + 1]), abs=1e-4)


@settings(deadline=None)
@given(st.lists(WORD, min_size=1, max_size=8, unique=True), st.lists(st.text(alphabet="abcd", min_size=3, max_size=6), min_size=1, max_size=3))
def test_skipped_pairs_are_unlike(words, landmarks):
    own = toxicity.self_kernel(landmarks)
    found = toxicity.likeness(words, landmarks, own)
    for i, w in enumerate(words):
        for j, z in enumerate(landmarks):
            norms = [product(w[: a + 1], w[: a + 1]) for a in range(len(w))]
            like = max((product(w[: a + 1], z) / (n * own[j]) ** 0.5 for a, n in enumerate(norms) if n > 0), default=0)
            if abs(like - toxicity.LEAST) > 1e-3:
                assert found[i, j] == pytest.approx(min(like, 1) ** toxicity.POWER if like > toxicity.LEAST else 0, abs=1e-3)


def test_units_join_spelt_out_words():
    assert toxicity.units("You I D I O T !! a b".split()) == ["^you", "^idiot", "^a", "^b"]


def test_gaps_and_insertions_are_tolerated():
    z = ["^idiot"]
    own = toxicity.self_kernel(z)
    exact, longer, gapped, other = toxicity.likeness(["^idiot", "^idiotic", "^id-iot", "^handle"], z, own)[:, 0]
    assert exact == pytest.approx(1, abs=1e-3) and longer == pytest.approx(1, abs=1e-3)
    assert 0 < gapped < 1 and other == 0


@pytest.mark.parametrize("word,gapped", [("idiot", ["id.io.t", "i-d-i-o-t", "id\u200bi\u200bot"]), ("stupid", ["st.up.id"]), ("pathetic", ["pa.th.etic"])])
def test_two_and_more_inserted_marks_are_tolerated(word, gapped):
    z = ["^" + word]
    own = toxicity.self_kernel(z)
    read = toxicity.word_likeness([z[0], *("^" + w for w in gapped)], z, own)[:, 0]
    assert read == pytest.approx(1, abs=1e-3)


@pytest.mark.parametrize("word", ["idxiot", "idxixot", "ixdixot"])
def test_inserted_letters_are_tolerated(word):
    z = ["^idiot", "^moron"]
    own = toxicity.self_kernel(z)
    like, other = toxicity.word_likeness(["^" + word], z, own)[0]
    assert like >= (toxicity.INSERT_DECAY ** (len(word) - 5)) ** toxicity.POWER - 1e-6 and other == 0
    assert not toxicity.inserted_likeness(["^ixxxdiot", "^idio", "^handle", "^"], z).any()


@settings(deadline=None)
@given(WORD, st.text(alphabet="abcd", min_size=3, max_size=5))
def test_the_whole_landmark_is_found_through_few_inserted_characters(word, z):
    found = toxicity.inserted_likeness([word], [z])[0, 0]
    ways = [at for n in [len(z)] for at in combinations(range(len(word)), n) if "".join(word[i] for i in at) == z]
    inserted = min((at[-1] + 1 - len(z) for at in ways), default=99)
    wanted = (toxicity.INSERT_DECAY**inserted) ** toxicity.POWER if inserted <= toxicity.INSERTED else 0
    assert found == pytest.approx(wanted, abs=1e-5)


def test_very_long_words_take_time_by_their_length_alone():
    z = ["^idiot"]
    own = toxicity.self_kernel(z)
    words = ["^" + "x" * 1_000_000, "^idiot" + "y" * 200_000, "^" + "ab" * 5000] + [f"^short{i}" for i in range(3000)]
    began = time.perf_counter()
    like = toxicity.word_likeness(words, z, own)[:, 0]
    assert time.perf_counter() - began < 30
    assert like[0] == 0 and like[1] == pytest.approx(1, abs=1e-3) and not like[2:].any()
    parts = toxicity.stretches(words[2])
    assert set(map(len, parts[:-1])) == {toxicity.STRETCH} and len(parts) < 2 * len(words[2]) / toxicity.STRETCH + 2
    assert all(a[toxicity.STRETCH // 2 :] == b[: toxicity.STRETCH // 2] for a, b in zip(parts, parts[1:-1]))
    assert words[2].endswith(parts[-1])


def test_held_out_recall_at_the_contracts_threshold(spark):
    labels = read_table(spark, SF, "labels")
    known = {r.doc_id: r.toxic for r in labels.collect()}
    found = [r for r in toxicity.score_toxicity(read_table(spark, SF, "documents"), labels).collect() if r.held_out]
    toxic, clean = ([r.score >= 0.7 for r in found if known.get(r.doc_id) == y] for y in (1, 0))
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.03 * len(clean)


def test_a_sample_is_bounded_in_rows_and_in_length(spark):
    rows = [(i % 5, f"text {i % 7}") for i in range(3000)] + [(9, "x" * 300), (10, None), (11, "one")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)] + [(11, 0)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = labelled_sample(docs, labels, "toxic", F.lit(True), 6, 200).collect()
    assert len(found) == 6 and len({(r.doc_id, r.text) for r in found}) == 6
    whole = labelled_sample(docs, labels, "toxic", F.lit(True), 1000, 200).collect()
    assert len(whole) == 36 and {(r.doc_id, r.label) for r in whole} == {(i, i % 2) for i in (0, 1, 2, 3, 4, 10)}


def test_gapped_insults_score_above_clean_words():
    insults, plain = ["idiot", "moron", "stupid"], "the table stands near a window of this old house".split()
    texts = [f"you are such {'an' if i % 2 else 'a'} {insults[i % 3]} today" if i < 60 else " ".join(plain[i % 5 : i % 5 + 6]) for i in range(120)]
    machine = toxicity.fit(texts, np.array([1.0] * 60 + [0.0] * 60))
    scorer = toxicity.Scorer(machine)
    clean, *gapped = scorer.scores(["this is good", "this is id.io.t good", "this is mo.ro.n good", "this is st.up.id good"])
    assert min(gapped) > clean
