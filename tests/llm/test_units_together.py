"""Units that the library has not met go to it many at a time, and their ids are still those of the whole texts."""

import random

import numpy as np
import pytest

from tallyforge.llm.unit_encoder import UnitEncoder, vocabulary

PIECES = ["a", "word", " ", "  ", "\n", "\n\n\t", "é", "日本", "1", "'s", "'ll", "!", "...", ".", ",", "　", "\x85", "\x1c", "\x00", "🙂", " the", "<|endoftext|>", "​", "\xa0"]


@pytest.fixture(scope="module")
def path():
    return vocabulary("byte_bpe_50k.json")


def test_ids_are_those_of_whole_texts(path):
    from tokenizers import Tokenizer

    toss, whole = random.Random(5), Tokenizer.from_file(path)
    encoder = UnitEncoder(path)
    for _ in range(40):
        texts = ["".join(toss.choice(PIECES) for _ in range(toss.randint(0, 40))) for _ in range(50)]
        expected = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
        assert encoder.encode(texts) == expected == encoder.encode(texts)


def test_new_units_are_sent_together(path):
    encoder, sent = UnitEncoder(path), []
    library = encoder._tokenizer

    class Counted:
        def encode_batch_fast(self, texts, **how):
            sent.extend(texts)
            return library.encode_batch_fast(texts, **how)

    encoder._tokenizer = Counted()
    encoder.encode([" ".join(f"w{i}x{k}" for i in range(100)) for k in range(100)])
    assert len(sent) < 200  # 10,000 units
