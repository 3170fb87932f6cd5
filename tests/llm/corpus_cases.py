"""Rows and fixtures for the tests of the corpus operators."""

import random

import pytest

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: columns that the operators use or return themselves
CLASHING = (
    "n_words kept size target taken copies component_id row v node level name hashes spans items codes notes base labels "
    "words bits n id text_hash keep_id group_size perplexity least most n_tokens n_bytes"
).split()


def edge_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passage, long = say(80), say(30_000)
    near = passage.split()
    rows = [
        (1, passage, "en", "b", 1),
        (2, passage.upper(), "en", "a", 1),
        (3, None, "en", "a", None),
        (4, "", None, None, 0),
        (5, " \t\n\x0b .!?", "xx", "ü", 8),
        (6, long, "en", "a", 5),
        (7, long + " tail", "en", "a", 5),
        (8, " ".join(near[:70] + ["other", "words"] + near[72:]), "de", "b", 5),
        (9, say(40) + " " + passage + " " + say(40), "de", "b", 5),
        (10, "one two three", "en", "c", 3),
        (11, "One two THREE", "en", "c", 3),
        (12, "mit license MIT License and the Apache License, GNU General Public License v2", "en", "c", 3),
        (13, "write a.b@x.example.org or 10.0.0.1, +1 (555) 010-9999; 4111 1111 1111 1111.", "en", None, 3),
        (14, "a.b@x 300.1.1.1 4111 1111 1111 1112 +12 " + "9" * 3000 + " " + "x" * 5000, "en", None, 3),
        (15, "Ünïcode İstanbul KELVIN <|endoftext|> ͸ don't 12,5    end", "fr", "c", 3),
        (None, passage, "en", "b", 1),
        (None, None, None, None, None),
        (16, "x", "en", "a", 1),
        (17, say(10), "en", "a", 1),
    ]
    return rows + [rows[0], rows[0], rows[9], rows[3], (16, "y", "en", "a", 1)]


@pytest.fixture(scope="session")
def edge(spark):
    """The rows with columns whose names the operators use themselves, in five partitions."""
    df = spark.createDataFrame(edge_rows(), DOCS).repartition(5)
    for name in CLASHING:
        df = df.selectExpr("*", f"'own' AS {name}")
    path = _stored(df)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


def _stored(df):
    from contestry.session import new_folder

    path = new_folder(df.sparkSession, "edge")
    df.write.parquet(path)
    return path


@pytest.fixture(scope="session")
def text_rows():
    """(doc_id, text) in a list, for brute force."""
    return lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
