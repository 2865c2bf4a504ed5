"""Small inputs of the tests in this folder."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra=None):
    """Documents from (doc_id, text) or (doc_id, text, source); ``extra`` adds constant columns."""
    from pyspark.sql import functions as F

    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, DOCS)
    for name, value in (extra or {}).items():
        df = df.withColumn(name, F.lit(value))
    return df


#: Null, empty, blank, one word, repeated rows, a null id, odd characters, a long text.
UGLY = [
    (1, None), (2, ""), (3, " \t\n"), (4, "Word"), (5, "same text in two rows, twice"), (5, "same text in two rows, twice"),
    (None, "a text without an id but with words"), (6, "né e   zero\x00byte \x1f x"), (7, "word " * 30000),
    (8, "a b\x0bc\x0cd"),
]


def words(rng: random.Random, n: int, vocabulary: int = 40) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
