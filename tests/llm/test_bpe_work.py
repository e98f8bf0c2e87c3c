"""What op9's encoder looks up per word, and that its cut of whole slices is the library's."""

import random

import pytest
from tokenizers import Tokenizer

from twinfold.llm import bpe
from twinfold.llm.queries import default_vocabulary


class Counted(dict):
    """A table that counts what it is asked."""

    asked = 0

    def get(self, *args):
        self.asked += 1
        return super().get(*args)


@pytest.fixture(scope="module")
def automaton():
    return bpe.load_automaton(default_vocabulary())


def test_a_word_is_looked_up_once_in_a_slice_of_texts(automaton):
    encoder = bpe.Encoder(automaton)
    encoder.words = Counted()
    text = "the storm came over the hills. " * 5000
    assert encoder.encode(text) == ",".join(map(str, Tokenizer.from_file(default_vocabulary()).encode(text, add_special_tokens=False).ids))
    assert encoder.words.asked < 20


def test_only_lengths_that_labels_have_are_tried(automaton, monkeypatch):
    rng = random.Random(3)
    words = [("".join(rng.choice("bcdfghjklmnpqrstvwxz0123456789") for _ in range(60))).encode() for _ in range(50)]
    monkeypatch.setattr(automaton, "ids", Counted(automaton.ids))
    tokens = sum(len(automaton.encode_word(w)) for w in words)
    assert automaton.ids.asked < 6 * tokens  # a place has 60 lengths, few of which a label can have


@pytest.mark.parametrize("hand_on", [1_000_000, 7])
def test_slices_are_cut_as_the_library_cuts(automaton, monkeypatch, hand_on):
    monkeypatch.setattr(bpe, "HAND_ON", hand_on)
    library, encoder, rng = Tokenizer.from_file(default_vocabulary()), bpe.Encoder(automaton), random.Random(hand_on)
    signs = ["'", "'s", "'re", "'ve", "'ll", "'d", "'m", "'t", "'S", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", " ", "​", "a", "re", "storm"]
    signs += ["é", "中", "١", "½", "Ⅷ", "_", "!", "…", "\U0001f600", "́", "<|endoftext|>", "<|endo", "23", "\x00", "x" * 70]
    for _ in range(60):
        texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(30))) for _ in range(rng.randrange(1, 30))]
        ids, at = encoder.encode_all(texts)
        assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert [str(x, "utf-8") for x in encoder.joined(encoder.labels, ids, at)] == texts
