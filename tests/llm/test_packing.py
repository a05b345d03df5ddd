"""The word encoder of the packing: ids as the tokenizer gives them, and how often words are looked up."""

import struct

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer

from salesmart.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


class Counting(dict):
    """A dictionary that counts what is asked of it."""

    asked = 0

    def get(self, key, default=None):
        self.asked += 1
        return super().get(key, default)

    def __getitem__(self, key):
        self.asked += 1
        return super().__getitem__(key)


def test_ids_are_those_of_whole_texts():
    texts = [None, "", " ", "\n\n a  b\t", "  x", "x\x1cy z\x0b\x0cq", "Été é Σας don't, 12a 你好!", "a b", "word " * 2000]
    encoder = packing.WordEncoder(PATH)
    assert encoder.by_words
    whole = Tokenizer.from_file(PATH)
    for _ in range(2):  # new words, then known ones
        for text, data in zip(texts, encoder.encode([t and t.encode() for t in texts])):
            ids = whole.encode(text or "", add_special_tokens=False).ids
            assert data == struct.pack(f"<{len(ids)}I", *ids), text
    assert encoder.encode([]) == [] and encoder.encode([None]) == [b""]


def test_a_word_is_looked_up_once_in_a_batch():
    encoder = packing.WordEncoder(PATH)
    encoder.encode([b"one two three"])
    encoder.words = Counting(encoder.words)
    encoder.encode([b"one two three " * 1000, b"three two " * 1000])
    assert encoder.words.asked <= 10
