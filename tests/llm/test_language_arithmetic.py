"""The language model's features and probabilities against plain loops."""
import math
import random

import numpy as np
import pytest

from tabclass.llm import language_id as L


def plain_counts(text):
    """Counts of subwords of 2, 3 and 4 bytes of a text, one byte at a time."""
    folded = []
    for i, c in enumerate(text):
        if 65 <= c <= 90:
            c += 32
        elif c < 97 or 122 < c < 128:
            c = 32
        elif i and text[i - 1] == 0xC3 and 0x80 <= c <= 0x9E:
            c += 32
        folded.append(c)
    out = [0] * (1 << L.BUCKET_BITS)
    for size in (2, 3, 4):
        for i in range(len(folded) - size + 1):
            gram = folded[i : i + size]
            if 32 in gram[1:-1] or set(gram) == {32} and size == 2:
                continue
            value = 0
            for c in gram:
                value = (value * 257 + c) % 2**32
            out[((value * 0x9E3779B1 + size * 0x85EBCA6B) % 2**32) >> (32 - L.BUCKET_BITS)] += 1
    return out


def test_subword_counts_equal_a_plain_loop():
    rng = random.Random(3)
    texts = ["", "a", "Äß ÉÉ x", "  ", "word word"] + ["".join(rng.choice("abÄéß xY.,7\n𝒳") for _ in range(rng.randrange(60))) for _ in range(40)]
    coded = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(coded), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in coded])])
    got = L.gram_counts(data, offsets)
    for c, row in zip(coded, got):
        assert row.tolist() == plain_counts(c)


def test_probabilities_equal_a_plain_softmax():
    rng = np.random.default_rng(4)
    width = 1 << L.BUCKET_BITS
    model = L.Model(["a", "b", "c"], rng.normal(0, 30, (width, 3)).astype(np.float32), rng.normal(size=3).astype(np.float32), 0.4)
    counts = rng.poisson(0.01, (6, width)).astype(np.float32)
    counts[2] = 0  # a text without letters
    for row, got in zip(counts, model.probabilities(counts)):
        total = max(1, sum(row))
        z = [float(model.bias[k]) + sum(float(n) / total * float(model.table[b, k]) for b, n in enumerate(row) if n) for k in range(3)]
        weights = [math.exp(v - max(z)) for v in z]
        assert got.tolist() == pytest.approx([w / sum(weights) for w in weights], abs=1e-5)
