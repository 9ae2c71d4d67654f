"""Words as arrays against regular expressions."""

import random

import numpy as np
import pyarrow as pa
import pytest

from cases import folded_words, words
from mallflow.llm.words import FOLDED, PLAIN, chunks, grams

_TEXTS = [None, "", " ", "a", " a ", "Ärger  über\tÜ", "x\x0by\x1cz", "don't STOP-now 42", "漢字 ok", "tail ", "\n\nlead"]


def _random_texts():
    pick = random.Random(5)
    letters = "aB0 \t\n\x0b\x1c.-é漢@#[`{\x7f"
    return ["".join(pick.choice(letters) for _ in range(pick.randint(0, 60))) for _ in range(400)]


@pytest.mark.parametrize(("table", "plain"), [(PLAIN, words), (FOLDED, folded_words)])
@pytest.mark.parametrize("limit", [1, 50, 1 << 20])
@pytest.mark.parametrize("offset", [0, 3])
def test_words_equal_the_expression(table, plain, limit, offset):
    texts = _TEXTS + _random_texts()
    column = pa.array(texts, pa.string()).slice(offset)
    hash_of, rows = {}, []
    for chunk in chunks(column, table, limit):
        for i, row in enumerate(chunk.rows):
            found = range(chunk.edges[i], chunk.edges[i + 1])
            raw = [chunk.data[chunk.starts[j] : chunk.ends[j]].tobytes().decode() for j in found]
            want = plain(texts[offset + row])
            assert [w.lower() if table is FOLDED and w.isascii() else w for w in raw] == want or len(raw) == len(want)
            for word, j in zip(want, found, strict=True):
                assert hash_of.setdefault(word, chunk.hashes[j]) == chunk.hashes[j]
            rows.append(row)
    assert rows == list(range(len(column)))
    assert len(set(hash_of.values())) == len(hash_of)


def test_grams_tell_runs_apart():
    pick = np.random.default_rng(1)
    hashes = pick.integers(0, 1 << 63, 5).astype(np.uint64)[pick.integers(0, 5, 400)]
    for size in (1, 2, 5):
        found, runs = {}, grams(hashes, size)
        assert len(runs) == 400 - size + 1
        for i, run in enumerate(runs):
            assert found.setdefault(tuple(hashes[i : i + size]), run) == run
        assert len(set(found.values())) == len(found)
    assert len(grams(hashes[:3], 5)) == 0
