import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi pi rho sigma tau été señor ßen".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Rows of documents: plain, copies, near copies, shared passages, personal data, licences, blank and long texts."""
    rng = random.Random(7)
    texts = [sentence(rng, rng.randint(1, 150)) for _ in range(120)]
    passage = sentence(rng, 60)
    texts += [texts[3]] * 6 + [t.replace("alpha", "omega", 1) for t in texts[:12]]
    texts += [sentence(rng, 20) + "\n" + passage + "\n" + sentence(rng, 20) for _ in range(10)]
    texts += ["mail me.at@x-y.example.org or +1 (212) 555-0142, 10.0.0.256 and 10.0.0.25 " + sentence(rng, 30)]
    texts += ["card 4111 1111 1111 1111 1 4111111111111111 " + sentence(rng, 30)]
    texts += [sentence(rng, 30) + "\nReleased under the MIT License.", "the same line here\n" * 40, "  \n\t ", "", "one", "two words"]
    texts += [" ".join([sentence(rng, 400)] * 3), sentence(rng, 6000), "a" * 3000]
    return [(i, t, "en", ["b", "a", "c", None, "é"][i % 7 % 5], len(t)) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def documents(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids and texts, repeated rows, and columns named like those the operators make."""
    rows = [(None, None, None, 1), (None, "x y z " * 9, "s", 2), (5, None, "s", 3), (5, "a b c d " * 40, "s", 4)]
    rows += [(5, "a b c d " * 40, "s", 4)] * 3 + [(6, "", None, 5), (7, " \n ", "t", 6), (8, "Ünïcode ﬀ 𝔘 " * 30, "t", 7)]
    names = "doc_id long, text string, source string, fp long"
    df = spark.createDataFrame(rows, names)
    for name in ("row", "row_id", "key", "size", "spans", "ids", "start", "n_rows", "tie", "part", "kept", "component_id", "target"):
        df = df.selectExpr("*", f"'{name}' as {name}")
    return df


@pytest.fixture(scope="session")
def empty(documents):
    return documents.limit(0)
