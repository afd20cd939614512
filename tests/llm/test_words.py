import random

import numpy as np
import pyarrow as pa

from tests.llm.helpers import words
from ticktide.llm.words import text_slices, words_of

SIGNS = ["a", "B", "é", " ", "  ", "\n", "\t", "\x0b", "\xa0", "\x1c", "日"]


def random_texts(count=400, seed=2):
    rng = random.Random(seed)
    return ["".join(rng.choice(SIGNS) for _ in range(rng.randrange(12))) for _ in range(count)]


def test_words_of_whole_texts_at_any_offset():
    texts = random_texts()
    column = pa.array(texts, pa.large_string())
    for part in (column, column[7:90]):
        found = words_of(part, lower=True)
        tokens = found.tokens()
        for text, low, high in zip(part.to_pylist(), found.first[:-1], found.first[1:]):
            assert tokens[low:high] == [w.lower() for w in words(text)]


def test_equal_words_and_only_those_have_equal_hashes():
    found = words_of(pa.array(random_texts(), pa.large_string()))
    assert len(set(found.tokens())) == len(np.unique(found.hashes()))


def test_lines_hold_a_word():
    for texts in (random_texts(), ["", "\n\n", "a\nb", "\na\n \n", "x"]):
        found = words_of(pa.array(texts, pa.large_string())).lines()
        tokens = found.tokens()
        for text, low, high in zip(texts, found.first[:-1], found.first[1:]):
            assert tokens[low:high] == [line.encode() for line in text.split("\n") if words(line)]


def test_slices_hold_every_row_once():
    batch = pa.record_batch([pa.array(["a" * 50, None, "", "b" * 500, "c"])], ["text"])
    parts = list(text_slices(batch, "text", 60))
    assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
    assert [part.num_rows for part in parts] == [3, 1, 1]
