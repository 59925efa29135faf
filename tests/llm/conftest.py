import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for columns of their own.
CLASHING = ("tag", "node", "path", "size", "shard", "slot", "line_no", "words", "digest", "score", "kept", "label", "ids", "block")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents of (doc_id, text) or (doc_id, text, lang, source) tuples, with columns of clashing names beside."""

    def make(rows, clashing=True):
        full = [(*r, *[None] * (4 - len(r)), None) for r in rows]
        docs = spark.createDataFrame(full, SCHEMA)
        return docs.select("*", *[F.lit("x").alias(c) for c in CLASHING]) if clashing else docs

    return make


WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed, n):
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(60)) for _ in range(n))


@pytest.fixture(scope="session")
def awkward(make_docs):
    """Nulls in every column, empty, blank, very long and equal texts, ties, repeated rows."""
    long_text = "\n".join(prose(k, 40) for k in range(400))
    return make_docs([
        (1, prose(1, 90), "en", "a"), (2, prose(1, 90), "en", "a"), (2, prose(1, 90), "en", "a"), (3, None, None, None),
        (4, "", "en", "b"), (5, " \n\t ", "en", "b"), (None, prose(1, 90), "en", None), (None, prose(2, 12), None, "c"),
        (6, long_text, "de", "a"), (7, long_text + " end", "de", "c"), (8, "one", "en", "b"), (9, "one", "en", "b"),
        (10, "Ünïcode – 日本語 <|endoftext|> ΣΑΣ", "xx", "c"), (11, "two words", "en", "c"), (-5, prose(3, 60), "en", "c"),
    ])


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
