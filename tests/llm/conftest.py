import random

import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n):
    return " ".join(rng.choice("aeiou") + rng.choice("bcdfgh") * rng.randint(1, 3) + str(rng.randint(0, 300))
                    for _ in range(n))


def changed(rng, text, n):
    """``text`` with ``n`` words replaced."""
    w = text.split(" ")
    for i in rng.sample(range(len(w)), n):
        w[i] = f"new{rng.randint(0, 10 ** 6)}"
    return " ".join(w)


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source, n_chars): copies, near copies, shared passages and odd rows."""
    rng = random.Random(7)
    texts = [sentence(rng, rng.randint(1, 150)) for _ in range(25)]
    base = sentence(rng, 160)
    texts += [changed(rng, base, rng.randint(1, 9)) for _ in range(30)] + [base, base.upper(), base]
    passage = sentence(rng, 60)
    texts += [sentence(rng, 40) + " " + passage + "\n" + sentence(rng, 20) for _ in range(8)]
    line = "the same line everywhere"
    texts += [sentence(rng, 12) + "\n" + line + " \n\n" + sentence(rng, 9) for _ in range(14)]
    texts += ["", " \t\n ", None, None, "one two three", "ONE two\tthree", "x " * 90, sentence(rng, 20_000)]
    rows = [(i, t, "en", f"src{i % 13}" if i % 17 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[26], None, "src1", 1), (None, None, None, None, None)]
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOC_SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def clashing(docs):
    """The corpus with columns that have the names operators use inside."""
    from pyspark.sql import functions as F

    names = ["v", "fp", "h", "n", "key", "set", "size", "taken", "cut", "parts", "words", "places", "score",
             "t_id", "g_id", "m_size", "shard", "slot", "n_lines", "r", "p"]
    return docs.select("*", *[F.lit(k).alias(c) for k, c in enumerate(names)])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
