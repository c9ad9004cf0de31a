import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
CLASHING = {"row": "a", "node": "b", "key": "c", "d": "d", "size": "e", "u": "f", "score": "g", "taken": "h", "n": "i", "media": "j", "_row": "k", "bucket": "l", "_kept_row": "m", "_mix_id": "n", "_leak_item": "o"}


@pytest.fixture(scope="session")
def corpus(spark):
    def make(texts, sources=None, extra=False):
        """A table of documents; texts: a list, or pairs of id and text."""
        pairs = texts if texts and isinstance(texts[0], tuple) else list(enumerate(texts))
        rows = [(i, t, "en", sources[k] if sources else "s", len(t) if t else 0) for k, (i, t) in enumerate(pairs)]
        df = spark.createDataFrame(rows, SCHEMA)
        if extra:
            from pyspark.sql import functions as F

            df = df.select("*", *[F.lit(v).alias(c) for c, v in CLASHING.items()])
        return df

    return make


@pytest.fixture(scope="session")
def odd(corpus):
    """Nulls in every column, an empty and a very long text, ties, a repeated row, and clashing names."""
    long = " ".join(f"word{k % 977} of{k % 13}" for k in range(20_000))
    pairs = [(1, "a b c d e f"), (2, None), (None, "a b c d e f"), (4, ""), (5, long), (1, "a b c d e f"), (7, " \n\t "), (8, "x"), (None, None), (9, "É è 🙂\x00 z")]
    return corpus(pairs, [None, "s", "t", None, "s", None, "t", "u", None, "s"], extra=True)


@pytest.fixture
def empty(corpus, spark):
    return spark.createDataFrame([], SCHEMA)
