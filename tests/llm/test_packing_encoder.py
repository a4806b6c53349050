"""The encoder of the packing operator against the library's own ids."""

from __future__ import annotations

import random

import numpy as np
import pytest

from edaphon.llm import packing
from edaphon.llm.queries import tokenizer_path


class Counted:
    """The library's tokenizer; keeps the texts that were given to it in bulk."""

    def __init__(self, tokenizer):
        self.tokenizer, self.bulk = tokenizer, []

    def encode(self, *args, **options):
        return self.tokenizer.encode(*args, **options)

    def encode_batch_fast(self, texts, **options):
        self.bulk += texts
        return self.tokenizer.encode_batch_fast(texts, **options)


@pytest.fixture()
def encoder():
    return packing.Encoder(tokenizer_path())


def library(encoder, text):
    return np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_words_are_learned_once_whatever_mark_is_behind(encoder):
    encoder.tokenizer = counted = Counted(encoder.tokenizer)
    words = ["".join(random.Random(k).choices("aeinorstl", k=8)) for k in range(300)]
    texts = ["x " + " ".join(w + mark for w in words) for mark in ("", ".", ",", ";", "!", "?")]
    assert encoder.encode(texts) == [library(encoder, t) for t in texts]
    assert sum(map(len, counted.bulk)) <= sum(len(w) + 1 for w in words) + 10
    given = len(counted.bulk)
    assert encoder.encode(texts[::-1]) == [library(encoder, t) for t in texts[::-1]]
    assert len(counted.bulk) == given


@pytest.mark.parametrize("cache", [packing.CACHE, 2_000])
def test_ids_of_awkward_texts(encoder, cache, monkeypatch):
    monkeypatch.setattr(packing, "CACHE", cache)
    monkeypatch.setattr(packing, "LEARNED", 40)
    pick = random.Random(cache)
    plain = [" "] * 6 + ["\n"] * 2 + [*"ab1é.,;:!?)\"'-_<", "'s", "<|endoftext|>", "ß", "ɏ", "ɐ", "²", "一", "😀", "\x00", "Ġ", "​", "᠎"]
    for letters in (plain, [*plain, "\t", "\xa0", "　", "\x1c", "\x85", "\r", "  ", "\n\n"]):
        for _ in range(20):
            texts = ["".join(pick.choices(letters, k=pick.randrange(14))) for _ in range(100)]
            assert encoder.encode(texts) == [library(encoder, t) for t in texts]


def test_marks_behind_every_character(encoder):
    texts = [f"{chr(c)}{mark} {chr(c)}{mark}\n{chr(c)}{mark}" for c in range(0x800) for mark in packing.MARKS]
    assert encoder.encode(texts) == [library(encoder, t) for t in texts]
