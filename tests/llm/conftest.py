import random

import pytest

SYLLABLES = "the on er and ti ing éa tion sch ver ô re st in".split()


def prose(seed: int, words: int) -> str:
    r = random.Random(seed)
    text = " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(words))
    return text[:1].upper() + text[1:] + "."


LONG = "\n".join(prose(k, 60) for k in range(300))

#: (doc_id, text, lang, source): copies, near copies, nulls, empty and very long texts, repeated rows.
ROWS = [
    (1, prose(1, 90), "en", "a"), (2, prose(1, 90), "en", "a"), (3, prose(1, 90).replace(" on", " in", 1), "en", "b"),
    (4, prose(2, 120) + "\n" + prose(3, 30), "de", "a"), (5, prose(4, 80) + "\n" + prose(3, 30), None, None),
    (6, None, "en", "a"), (7, "", "en", "a"), (8, " \n\t ", "fr", "b"), (9, "word", "fr", "b"),
    (10, LONG, "en", "a"), (11, LONG + " tail", "en", "c"), (12, "la la la " * 200, "en", "c"),
    (None, prose(5, 50), "en", "a"), (None, prose(5, 50), "en", "a"), (13, prose(6, 60), "en", "a"), (13, prose(6, 60), "en", "a"),
    (14, "Licensed under the Apache License, Version 2.0.\n" + prose(7, 40), "en", "b"),
    (15, "token = \"9c8b45435718dcc700c184a7e303cdc64c6a8f7f\" " + prose(8, 40), "en", "b"),
    (16, "x y\tz  q \n\n<|endoftext|> 　日本 " + prose(9, 30), "ja", "b"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"


@pytest.fixture(scope="session")
def rows():
    return ROWS


@pytest.fixture(scope="session")
def odd(spark):
    """The rows, with columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    names = ("row", "kept", "n_words", "fp", "uid", "block", "score", "part", "weight", "probability", "words", "doc", "line", "in_text")
    return df.withColumns({n: F.lit(1) for n in names})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
