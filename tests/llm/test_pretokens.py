from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import regex

from lodgeframe.llm.pretoken import distinct_pretokens

ODD = [
    "", "a", "\0", "a\0", "\0a a\0 a", " a  a\n\n a", "it's we'll I've 's 're", "x" * 8, "x" * 9, "x" * 16, "x" * 17, " " + "y" * 15, " " + "y" * 16,
    "abcdefgh abcdefghi abcdefgh\u0100 abcdefg\xff abcdefg\xe9", "日本語 日本語", "\U0001f600 \U0010fffd a", "12345678 123456789", "\x1c \x85 \xa0a", "abcdefgh\0", "\ud800 a \ud800",
]


def spelled(texts):
    pieces, kinds, counts = distinct_pretokens(texts)
    every = [pieces[i] for i in kinds]
    cuts = np.cumsum([0, *counts])
    return [every[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def test_against_the_pattern():
    rng = random.Random(4)
    texts = ODD + ["".join(rng.choice("ab \0\xe9'sl1\n日") * rng.choice((1, 1, 7, 9)) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    pattern = regex.compile(public_tokenizers.PATTERN)
    assert spelled(texts) == [pattern.findall(t) for t in texts]
    assert all(spelled([t]) == [pattern.findall(t)] for t in texts)
    assert spelled([]) == []


def test_equal_short_pieces_come_once():
    pieces, kinds, counts = distinct_pretokens([" word another-longer word" * 50, " word" * 9])
    assert len(pieces) == len(set(pieces)) < 10 and len(kinds) == sum(counts) > 200
