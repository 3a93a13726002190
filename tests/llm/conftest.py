import random

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session", autouse=True)
def tiny_batches(spark):
    """Batches so small that documents and tasks go over their ends."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")


@pytest.fixture(scope="session")
def odd_texts():
    """Texts of every kind: empty, blank, very short, very long, repeated, unusual characters."""
    rng = random.Random(5)
    base = [sentence(rng, n) for n in (12, 40, 90, 200)]
    near = []
    for text in base:
        for changes in (1, 2, 4, 9, 20):
            w = text.split()
            for _ in range(changes):
                w[rng.randrange(len(w))] = "changed"
            near.append(" ".join(w))
    crowd = sentence(rng, 150).split()
    crowd_texts = [" ".join([*crowd[:i], "odd", *crowd[i + 1 :]]) for i in range(40)]
    special = [
        None, "", " ", "\n\n", "a", "a b", "A B", "a b c", "\x0b\x0c\r", "one two three", "Ünïcödé ß Straße",
        "\U0001f600 smile \U0001f600", "x" * 5000, "## | ## | $$ %% && ** << >>", "12 345 6789", "tab\there\r\nand there",
        "same line\nsame line\nsame line", "a a a a a a a a a a a a", "  leading and trailing  ", "don't we'll I'd",
        "<|endoftext|> in a text", "<|im_end|>\n<|im_start|>system", sentence(rng, 30_000, 5000),
    ]
    return [*special, *base, *base, *near, *crowd_texts]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """The odd texts as documents, over several partitions."""
    rows = [(i, t, None if i % 7 == 0 else "en", None, None if t is None else len(t)) for i, t in enumerate(odd_texts)]
    return spark.createDataFrame(rows, DOCUMENT).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENT)


def clashing(df):
    """The frame with more columns, named as an operator might name its own."""
    from pyspark.sql import functions as F

    names = ["__id", "__gone", "__t1", "id_of", "t1_of", "gone_of", "order_of", "text_of", "kept_of", "at", "row", "bitmap", "row_of", "odd.name`"]
    names += ["id", "grp", "band", "key", "keys", "rank", "line", "d", "t", "n", "words", "label", "stats", "score", "part", "start", "h1", "u", "v"]
    more = df.withColumns({name: F.lit("x") for name in names if name not in df.columns})
    # a column that can be neither compared nor hashed
    return more.withColumn("extras", F.create_map(F.lit("a"), F.lit(1)))
