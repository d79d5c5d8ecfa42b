import itertools
import math

import numpy as np
import pyarrow as pa
import pytest

from pontualis.llm import language
from pontualis.llm.queries import QUERIES
from pontualis.llm.tables import table


def segmentations(word: bytes):
    for cuts in itertools.product((0, 1), repeat=len(word) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(word)]
        yield [word[a:b] for a, b in itertools.pairwise(at)]


@pytest.fixture
def toy():
    vocab = sorted({bytes([b]) for b in range(256)} | {b"\x01a", b"ab", b"abc", b"bc", b"\x01ab", b"ca"})
    pieces = language.Pieces(vocab)
    rng = np.random.default_rng(1)
    probability = rng.random((pieces.size + 1, 2))
    probability[-1] = 0
    return vocab, language.Model(["x", "y"], pieces, probability)


@pytest.mark.parametrize("word", [b"\x01a", b"\x01abcab", b"\x01cabca", "\x01äb".encode()])
def test_forward_sums_all_segmentations(toy, word):
    vocab, model = toy
    place = {p: i for i, p in enumerate(vocab)}
    got = model.word_scores(np.frombuffer(word, np.uint8)[None, :])[0]
    for k in range(2):
        total = sum(math.prod(model.probability[place[p], k] if p in place else 0 for p in s)
                    for s in segmentations(word))
        assert got[k] == pytest.approx(math.log(total))


def test_expected_counts(toy):
    vocab, model = toy
    place, word = {p: i for i, p in enumerate(vocab)}, b"\x01abcab"
    counts = language.expected_counts(model, np.array([1]), np.array([3.0]),
                                      np.frombuffer(word, np.uint8)[None, :])
    wanted, total = {}, 0
    for s in segmentations(word):
        chance = math.prod(model.probability[place[p], 1] if p in place else 0 for p in s)
        total += chance
        for p in s:
            wanted[p] = wanted.get(p, 0) + chance
    for p, chance in wanted.items():
        if p in place:
            assert counts[place[p], 1] == pytest.approx(3 * chance / total)
    assert not counts[:, 0].any()


@pytest.mark.parametrize("at_once", [1 << 14, 4])
def test_a_long_word_is_one_lattice(toy, monkeypatch, at_once):
    """Word by word and position by position as for many short words together."""
    vocab, model = toy
    rng = np.random.default_rng(2)
    words = [b"\x01abcab", b"\x01ab", *[b"\x01" + bytes(rng.choice(list(b"abcx"), 14)) for _ in range(4)]]
    for word in words:
        letters = np.frombuffer(word, np.uint8)[None, :]
        wanted = model.word_scores(letters)
        counts = [language.expected_counts(model, np.array([k]), np.array([2.5]), letters) for k in (0, 1)]
        with monkeypatch.context() as patch:
            patch.setattr(language, "LONGEST", 1)
            patch.setattr(language, "_AT_ONCE", at_once)
            assert model.word_scores(letters) == pytest.approx(wanted)
            for k in (0, 1):
                got = language.expected_counts(model, np.array([k]), np.array([2.5]), letters)
                assert got == pytest.approx(counts[k])


def test_very_long_words_neither_underflow_nor_are_cut(toy):
    _, model = toy
    model = language.Model(model.languages, model.pieces, model.probability / 20)
    word = np.frombuffer(b"\x01" + b"abcab" * 4000, np.uint8)[None, :]
    score = model.word_scores(word)
    assert np.isfinite(score).all() and (score < -1000).all()
    # Twice the word is about twice the sum's logarithm: nothing is lost at any border.
    half = model.word_scores(word[:, :10_001])
    assert score == pytest.approx(2 * half, rel=0.01)
    counts = language.expected_counts(model, np.array([0]), np.array([1.0]), word[:, :5001])
    sizes = np.array([len(p) for p in toy[0]] + [0])
    assert (counts[:, 0] * sizes).sum() == pytest.approx(5001)


def test_the_vocabulary_keeps_long_pieces():
    vocab = language.vocabulary(language.VOCABULARY)
    assert {b"\x01international", b"\x01particularly"} <= set(vocab)
    assert max(map(len, vocab)) > 12


def test_long_words_and_no_words(toy):
    _, model = toy
    got = model.text_scores(pa.array(["abc " * 3, None, "", "a" * 100 + " ab", "ABC abc abc"]))
    assert np.isfinite(got).all()
    assert got[0] == pytest.approx(got[4])
    assert not got[1].any() and not got[2].any()


def test_texts_are_scored_in_small_parts(toy, monkeypatch):
    _, model = toy
    find = language.find_words

    def bounded(data, offsets, inside):
        assert len(data) <= 1 << 18
        return find(data, offsets, inside)

    texts = [" ".join("abc"[i % 3] * (1 + j % 4) for j in range(3000)) for i in range(120)]
    alone = [model.text_scores(pa.array([t]))[0] for t in texts[:3]]
    monkeypatch.setattr(language, "find_words", bounded)
    got = model.text_scores(pa.array(texts))
    assert sum(map(len, texts)) > 1 << 20
    assert all((got[i] == alone[i % 3]).all() for i in range(len(texts)))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in table(spark, folder, "documents").collect()}
    rows = [r for r in QUERIES["op7_language_id"](spark, folder).collect()
            if r.held_out and lang[r.doc_id]]
    right = sum(r.lang_pred == lang[r.doc_id] for r in rows)
    assert len(rows) > 150 and right >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(odd, empty):
    model = language.train(odd)
    found = language.identify(odd, model, "found")
    assert found.columns == [*odd.columns, "found"]
    got = {r.doc_id: r.found.lang for r in found.filter("doc_id IS NOT NULL").collect()}
    assert [got[i] for i in (1, 2, 3, 9)] == ["und"] * 4
    assert got[4] == got[6] == got[7] == "en"
    nothing = language.train(empty)
    assert nothing.languages == []
    assert {r.found.lang for r in language.identify(odd, nothing, "found").collect()} == {"und"}
    assert language.identify(empty, model, "found").count() == 0
