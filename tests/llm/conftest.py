import random

import pytest

WORDS = ["alpha", "beta", "gamma", "delta", "river", "stone", "cloud", "forest", "window", "paper", "silver", "market", "garden", "winter", "bridge", "candle"]


def prose(seed: int, words: int, line: int = 25) -> str:
    rng = random.Random(seed)
    out = [rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing", "ly"]) + str(rng.choice(["", "", "a", "b"])) for _ in range(words)]
    return "\n".join(" ".join(out[k : k + line]) for k in range(0, words, line))


def edited(text: str, *places: int) -> str:
    words = text.split(" ")
    for p in places:
        words[p] = "changed"
    return " ".join(words)


#: ids, texts, and columns whose names operators use inside
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, kept string, row string, key string, score string, plan string"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", "x", "x", "x", "x", "x") for i, t, s in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    base = prose(1, 120)
    return [
        (1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (4, "one", "b"), (5, "one two three", "b"),
        (6, base, "a"), (7, base, "a"), (7, base, "a"), (8, edited(base, 40), "b"), (9, prose(2, 4000), "a"),
        (10, prose(3, 90), "c"), (None, "a text without an id of its own here", "c"), (11, "naïve – 日本語 🙂 <|endoftext|>  two  spaces ", None),
        (12, "x" * 3000, "a"), (13, "THE Same words", "a"), (14, "the same\twords", "b"),
    ]


@pytest.fixture(scope="session")
def odd_docs(make_docs, odd_rows):
    return make_docs(odd_rows)
