import random
import re

import pytest

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, key string,"
    " n_tokens string, line string, name string, hash string, u int, component int, row int,"
    " n_words string, __kept string, ids string, registers int"
)
CLASHES = ("k", "t", "l", "n", "h", 1, 2, 3, "w", "kept", "i", 4)


def words_of(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(
        "".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) + rng.choice(["", "", "", ".", ","])
        for _ in range(n)
    )


LONG = prose(1, 20_000)
ODD = [
    (None, "no id here", None),
    (1, None, "en"),
    (2, "", "en"),
    (3, " \t\n\r ", None),
    (4, "x" * 200_000, "en"),
    (5, LONG, "en"),
    (6, "one two", "en"),
    (7, "one two", None),
    (8, "Straße ½ ⅷ ² 漢字 ▁ ▁▁ \x1c é 😀 <|endoftext|> <s> <0x0A>\n\n\nĳ’s it's  IT'S\t", "de"),
    (8, "Straße ½ ⅷ ² 漢字 ▁ ▁▁ \x1c é 😀 <|endoftext|> <s> <0x0A>\n\n\nĳ’s it's  IT'S\t", "de"),
    (9, "12345 67.89 -- !!", None),
    (9, "another text of the same id", "fr"),
    (10, "…—“”", None),
    (11, LONG + " end", "en"),
]


def table(spark, rows):
    full = [(i, t, lang, "s", len(t) if t is not None else None, *CLASHES) for i, t, lang in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    return table(spark, ODD)


@pytest.fixture(scope="session")
def none(spark):
    return table(spark, [])
