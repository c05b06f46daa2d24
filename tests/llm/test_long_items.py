"""Nothing is cut at a bound of length: long words, numbers and schemes."""
import random
from collections import Counter

import numpy as np
import public_tokenizers

from clickrev.llm import language
from clickrev.llm.language import VOCABULARY_FILE, LanguageModel, WordScores, expected_counts, pieces_of
from clickrev.llm.pii import redacted, spans_of

LONG_WORD = "donaudampfschifffahrtsgesellschaftskapitän"  # 42 letters


def pieces():
    return pieces_of(public_tokenizers.path(VOCABULARY_FILE))


def model():
    rng = np.random.default_rng(1)
    shares = rng.random((3, len(pieces().pieces))) ** 4
    return LanguageModel(public_tokenizers.path(VOCABULARY_FILE), ("a", "b", "c"), shares / shares.sum(1, keepdims=True))


def plain_log(word, shares):
    """The sum over all segmentations, in logarithms."""
    known = {piece: k for k, piece in enumerate(pieces().pieces)}
    table = [0.0]
    for end in range(1, len(word) + 1):
        ways = [table[start] + np.log(max(shares[known[word[start:end]]], 1e-9)) for start in range(end) if word[start:end] in known]
        if word[end - 1] not in known:
            ways.append(table[end - 1] + np.log(1e-9))
        table.append(np.logaddexp.reduce(ways))
    return table[-1]


def test_words_of_every_length_sum_all_segmentations():
    rng = random.Random(2)
    scores, shares = WordScores(model()), model().probabilities
    words = [LONG_WORD, LONG_WORD[:30], LONG_WORD[:31], "".join(rng.choices("enrtsüß日x", k=400)), "a", "hello"]
    (found,) = scores.of([" ".join(words)])
    each = [scores.of([word])[0] for word in words]
    for word, logs in zip(words, each, strict=True):
        assert np.allclose(logs, [plain_log(word, row) for row in shares]), word
    assert np.allclose(found, sum(each))


def test_one_long_word_is_no_cut_word():
    scores = WordScores(model())
    whole = scores.of([LONG_WORD])[0]
    parts = scores.of([f"{LONG_WORD[:30]} {LONG_WORD[30:]}"])[0]
    assert (whole > parts).all()


def test_expected_counts_do_not_depend_on_the_way(monkeypatch):
    words = Counter({LONG_WORD[:25]: 3, "hello": 2, "日x日": 1, LONG_WORD: 1})
    usual = expected_counts(pieces(), words)
    monkeypatch.setattr(language, "_TABLE_LETTERS", 2)
    assert np.allclose(expected_counts(pieces(), words), usual)


def test_a_very_long_word():
    (logs,) = WordScores(model()).of(["ab" * 20_000])
    assert np.isfinite(logs).all()


def test_long_numbers_and_schemes():
    number = "1" * 30 + "2" * 15
    assert redacted(f"account {number}", spans_of(f"account {number}")) == "account [ACCOUNT]"
    text = "see averyveryverylongscheme+https://me:pw@host/x now"
    (span,) = [span for span in spans_of(text) if span[0] == "url"]
    assert text[span[1] : span[2]] == "averyveryverylongscheme+https://me:pw@host/x"
    text = "9+https://u:p@h"
    (span,) = [span for span in spans_of(text) if span[0] == "url"]
    assert text[span[1] : span[2]] == "https://u:p@h"
