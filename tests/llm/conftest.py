from __future__ import annotations

import random

import pytest

WORDS = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "nu") for b in ("ra", "ste", "vi") for c in ("n", "s", "t", "")]


@pytest.fixture
def odd_docs(spark):
    """Null ids, texts and other columns, empty and long texts, repeated rows, and columns named like results."""
    long = " ".join(random.Random(3).choices(WORDS, k=30_000))
    rows = [
        (1, "one two three four five six seven", "en", 5),
        (1, "one two three four five six seven", "en", 5),
        (2, None, None, None),
        (3, "", "fr", 1),
        (4, "One two three four five six SEVEN", "en", None),
        (5, " \t\n", None, 2),
        (6, "12 34 !!", "de", 2),
        (7, long, "en", 3),
        (8, long + " end", "en", 3),
        (9, "été à Noël çà et là", "fr", 4),
        (None, "no id here", "en", 4),
        (10, "", None, 4),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int")


@pytest.fixture
def prose(spark):
    """Random texts of a few kinds, with copies, near copies and chains of near copies."""
    rng = random.Random(11)
    texts = [" ".join(rng.choices(WORDS, k=rng.randint(1, 120))) for _ in range(150)]
    for i in range(40):
        words = texts[i].split()
        for _ in range(4):
            words = list(words)
            words[rng.randrange(len(words))] = rng.choice(WORDS)
            texts.append(" ".join(words))
    base = rng.choices(WORDS, k=90)
    for _ in range(120):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        texts.append(" ".join(words))
    texts += texts[:20]
    rng.shuffle(texts)
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]
