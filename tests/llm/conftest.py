import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, _judged int, copy int, root string"


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def make_docs():
    """Nulls, blanks, one-word, very long and repeated texts, near copies, shared passages and lines, odd characters."""
    rng = random.Random(5)
    texts = [None, "", " \t\n\x0b\x0c\r ", "one", "two words", "ümlaut é 🙂\u00a0nbsp", "\n\n\n"]
    base = [prose(rng, 120) for _ in range(6)]
    texts += base + base[:3] + [base[0].upper()]
    for b in base[:4]:
        w = b.split()
        for share in (0.01, 0.03, 0.06, 0.2):
            v = list(w)
            for i in rng.sample(range(len(v)), max(1, int(share * len(v)))):
                v[i] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(v))
    passage, line = prose(rng, 70), prose(rng, 30)
    for _ in range(5):
        texts.append(prose(rng, 40) + " " + passage + " " + prose(rng, 40))
        texts.append("\n".join([prose(rng, 12), line, "", prose(rng, 40), line]))
    texts.append("\n".join([line] * 4 + [prose(rng, 60)]))
    texts.append("a" * 5000)
    texts.append("la la la " * 400)
    texts.append(" ".join(f"{x}%%%" for x in prose(rng, 100).split()))
    texts.append("\n".join([prose(rng, 80), "home | news | about | contact | more", prose(rng, 80)]))
    texts.append(prose(rng, 30_000, 100_000))
    rows = []
    for i, t in enumerate(texts):
        lang = [None, "en", "fr"][i % 3]
        source = [None, "a", "b", "Z", "é"][i % 5]
        rows.append((i, t, lang, source, None if t is None else len(t), "clash", 1, 7, "clash"))
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_docs()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def repeated(spark, rows):
    """The same rows twice, and rows with a null id."""
    extra = [(None, *r[1:]) for r in rows[7:12]]
    return spark.createDataFrame(rows + rows + extra, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
