"""Small documents with the cases every operator must stand: nulls, empty and long texts, repeated rows, odd columns."""

import random
import re

WORD = re.compile("[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
# Extra columns are named like columns that the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n long, label string, word string, length int"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def prose(seed, words, vocabulary=300):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def texts():
    base = prose(1, 200)
    words = base.split()
    return [
        (0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one two three four"), (5, "One TWO three\tfour"),
        (6, base), (7, base.upper()), (8, " ".join(words[:-3])), (9, " ".join(words[3:] + ["new", "end"])),
        (10, " ".join(words[:100])), (11, prose(2, 60)), (11, prose(2, 60)), (None, prose(3, 50)), (12, prose(4, 20_000, 5000)),
        (13, "a b c d e f g h i j " * 30), (14, "line one\nline two\nline one\n\nline one"), (15, "über straße\u00a0naïve café 日本語 text"),
        (16, "x" * 5000), (17, "<|endoftext|> twice  spaced   text \n\n here <|endoftext|>"), (18, "a" + "\x1c" + "b c\x85d e"),
    ]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    langs = ("en", "fr", None)
    return spark.createDataFrame(
        [(i, t, langs[k % 3], "s", None, 0.5, 3, "x", None, None) for k, (i, t) in enumerate(rows)], SCHEMA
    )


def labels(spark):
    rows = [(6, 1, 0), (8, 1, 0), (13, 0, 1), (14, 0, None), (12, 1, 0), (3, None, None), (None, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def given(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")
