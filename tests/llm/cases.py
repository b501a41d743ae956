"""Awkward documents that every operator must take, and how to make tables of them."""

import random

LONG = "lorem ipsum " * 30_000
WORDS = "the of and thing house tree water stone river cloud maison rivière pierre nuage Haus Baum Wasser Stein".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) * (rng.random() < 0.2) for _ in range(n))


def awkward():
    """(doc_id, text, lang, source, n_chars) with nulls in every column, empty, long, equal and repeated rows."""
    rows = [
        (1, None, "en", "a", 3), (2, "", "en", None, 0), (3, " \t\n", None, "a", 3), (4, LONG, "en", "a", None),
        (5, prose(1, 60), "en", "b", 1), (6, prose(1, 60), "fr", "b", 1), (6, prose(1, 60), "fr", "b", 1),
        (None, prose(2, 50), "en", "c", 1), (None, None, None, None, None), (7, "###", "de", "c", 3), (8, "word", "de", "c", 4),
        (9, "two words", "de", "c", 9), (10, "日本語 テキスト \U0001F600 é", "ja", "c", 12),
    ]
    return rows + [(100 + i, prose(i, 5 + 7 * i % 90), ["en", "fr", "de"][i % 3], "d", i) for i in range(60)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows=None, partitions=3):
    frame = spark.createDataFrame(awkward() if rows is None else rows, SCHEMA).repartition(partitions)
    extra = {"size": "x", "fp": "y", "position": "z", "bucket": "b", "length": "l", "_task": "t", "shard": "s", "score": "q"}
    from pyspark.sql import functions as F

    return frame.withColumns({name: F.lit(value) for name, value in extra.items()})


def empty(spark):
    return documents(spark, [])
