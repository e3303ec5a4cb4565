"""Small tables of documents with every awkward row."""

import random

import pytest
from pyspark.sql import functions as F


def words(rng, n, vocab=400):
    return [f"w{rng.randrange(vocab)}" for _ in range(n)]


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text, source): copies, near copies, shared passages, empty, null and long texts, odd white space, repeated rows."""
    rng = random.Random(5)
    out = []
    base = [" ".join(words(rng, 40 + 13 * k)) for k in range(12)]
    passage = " ".join(words(rng, 120, 100_000))
    for k, t in enumerate(base):
        out.append((10 + k, t, f"s{k % 3}"))
    out += [(40, base[3], "s0"), (41, base[3], "s1"), (42, base[5].upper(), None)]
    for k in range(4):
        w = base[7].split(" ")
        w[10 * k + 3] = "changed"
        out.append((50 + k, " ".join(w), "s1"))
    for k in range(4):
        out.append((60 + k, " ".join(words(rng, 30)) + "\n" + passage + "\n" + " ".join(words(rng, 25)), "s2"))
    out += [(70, "", "s0"), (71, None, "s0"), (72, " \t\n ", "s1"), (73, "one", None), (74, "a b c d é 日本\x1c語", "s1"), (75, "double  space\n\nand\ttab \r\n end ", "s0")]
    out += [(76, " ".join(words(rng, 20_000, 3000)), "s0"), (77, "ab" * 3000, "s1"), (78, "x " * 1500, "s2")]
    out += [(None, base[1] + " tail", "s0"), (80, base[2], "s0"), (80, base[2], "s0"), (80, "another text of the same id", "s2")]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, source string, n_chars long")
    # extra columns with names that the operators use inside
    return df.withColumns({"th": F.lit("x"), "size": F.lit(1), "bucket": F.lit(None).cast("string"), "fingerprint": F.lit(2.5), "range": F.lit("r"), "task": F.lit(True)}).repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
