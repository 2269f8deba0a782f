"""Texts cut at spaces for the cache, against the tokenizers library on the whole texts."""

from __future__ import annotations

import random
from array import array

import pytest

from silverlode.llm import tokens

PARTS = [" ", "  ", "\n", "\t", "\r\n", "\xa0", "a", "Hello", "don't", "'s", "_", "42", ".", ",", "É", "ß", "…", "€", "\x00", "\x1c", "中"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_have_the_ids_of_whole_texts(name):
    encoder = tokens.Encoder(tokens.tokenizer_path(name))
    choose = random.Random(3)
    texts = ["".join(choose.choices(PARTS, k=choose.randrange(25))) for _ in range(3000)]
    whole = [array("I", e.ids).tobytes() for e in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == whole
    # Marks stay with their words, so there are fewer chunks to look up than runs.
    assert len(encoder._chunks("one, two, three.")) == 3


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_known_words_are_not_encoded_again(name, monkeypatch):
    encoder = tokens.Encoder(tokens.tokenizer_path(name))
    words = ["Wörter", "marks", "(both)", "$$$", "x1", "ends", "×é", "don't", "averyverylongwordbeyondthecache"]
    choose = random.Random(4)
    texts = [choose.choice([" ", "\n"]).join(choose.choices(words, k=30)) + choose.choice([".", ",\n", "!"]) for _ in range(500)]
    whole = [array("I", e.ids).tobytes() for e in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    sent = []
    encode = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda parts: sent.extend(parts) or encode(parts))
    assert encoder.encode(texts) == whole
    # Words beside marks and line breaks are the words themselves: plain ones are never encoded one by one.
    assert not [c for c in sent if c.strip().isalpha()]
    sent.clear()
    assert encoder.encode(texts) == whole
    assert all(len(c) > tokens.LONGEST_CACHED for c in sent)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_full_caches_change_no_ids(name, monkeypatch):
    monkeypatch.setattr(tokens, "_PLACES", 32)
    monkeypatch.setattr(tokens, "CACHE_SIZE", 20)
    monkeypatch.setattr(tokens, "PIECE_BYTES", 200)
    encoder = tokens.Encoder(tokens.tokenizer_path(name))
    choose = random.Random(5)
    texts = ["".join(choose.choices(PARTS, k=choose.randrange(12))) for _ in range(400)]
    whole = [array("I", e.ids).tobytes() for e in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == whole
