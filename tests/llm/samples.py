"""Small tables with the awkward cases, and plain re-computations to compare with."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators could use inside.
CLASHES = ("key", "kept", "bad", "place", "cuts", "row", "fp", "rank", "run", "run_words", "label", "words", "hash", "slot", "shard")


def awkward(spark, texts, ids=None):
    """Documents of ``texts``, nulls in every column, and extra columns with clashing names."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, None if k % 3 == 0 else "en", None, None) for k, (i, t) in enumerate(zip(ids, texts))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in CLASHES:
        df = df.withColumn(name, F.lit(7))
    return df


def none_of(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(seed, n_docs=40, words=60, vocabulary=400):
    """Texts of made-up words on several lines."""
    r = random.Random(seed)
    names = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(vocabulary)]
    texts = []
    for _ in range(n_docs):
        n = r.randint(1, 2 * words)
        texts.append("".join(r.choice(names) + ("\n" if r.random() < 0.08 else " ") for _ in range(n)))
    return texts


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
