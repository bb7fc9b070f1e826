"""Short ways to a word's class, figures and places, against the plain ones."""

import numpy as np
import pytest

from meterstone.llm import context_tree, pii, quality


def test_shape_of_words_by_the_short_way():
    words = ["a", "Ab", "ABC", "aB", "x1", "12", "1a2b3c4d", "a-b", "O'Neil", "_", "-", "é", "Été", "ſ", "ß", "名前", "ǅa", "ª1", "٣4", "a" * 64, "a" * 65, "A1" * 40, "aaBB11--", "ⅷ", "²"]
    for w in words:
        assert pii.shape(w) == pii._shape(w), w


def test_places_of_tokens_only_where_a_tag_is(monkeypatch):
    asked = []
    plain = pii.Tagger.tokens
    monkeypatch.setattr(pii.Tagger, "tokens", staticmethod(lambda t, b: asked.append(t) or plain(t, b)))
    own = pii.tagger()
    texts = ["the sky is blue today", "api key: 9f8e7d6c5b4a39281706f5e4d3c2b1a0"]
    found = own.spans(texts, [pii.base_spans(t) for t in texts])
    assert found[0] == [] and found[1] and asked == [texts[1]]


def test_figures_of_words_learned_in_parts(monkeypatch):
    words = [f"wort{i} größe{i % 7} 名{i % 3}".encode().split() for i in range(40)]
    one = quality.Pieces(quality.default_pieces(), quality.default_pairs())
    one.learn(words)
    monkeypatch.setattr(quality, "LEARNED", 7)
    two = quality.Pieces(quality.default_pieces(), quality.default_pairs())
    two.learn(words)
    for w in words:
        chars = sum(len(x.decode()) for x in w)
        assert one.figures(w, chars) == two.figures(w, chars, two.numbers(w))
    assert quality.repeat_words(words[0] * 4, numbers=one.numbers(words[0] * 4)) == quality.repeat_words(words[0] * 4) > 0


def test_places_of_grams_by_hash_and_search():
    rng = np.random.default_rng(3)
    grams = np.unique(rng.integers(0, 1 << 40, 50_000))
    codes = rng.choice(grams, 400_000)
    assert (context_tree.Places(grams).of(codes, step=1000) == np.searchsorted(grams, codes)).all()
    own = context_tree.Places(grams)
    own.slots[:] = 0  # every slot held by another gram
    assert (own.of(codes) == np.searchsorted(grams, codes)).all()
    with pytest.raises(ValueError):
        own.of(np.array([int(grams[-1]) + 1]))
