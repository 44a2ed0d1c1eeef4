from __future__ import annotations

import random

import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "en": "the and that with from river stone letter window garden under bright morning paper answer weather thought".split(),
    "de": "der und nicht mit auch straße fenster garten schlüssel morgen antwort wetter gedanke über brücke zeichen".split(),
}


def prose(rng: random.Random, lang: str, n: int) -> str:
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "", ".", ","]) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """Rows of documents: two languages, exact and near copies, odd texts, nulls in every column, repeated rows."""
    rng = random.Random(7)
    out = []
    for i in range(60):
        lang = ("en", "de")[i % 2]
        out.append((i, prose(rng, lang, rng.randint(3, 120)), lang, f"s{i % 3}", i))
    base = out[10][1].split() + prose(rng, "en", 80).split()
    for i in range(60, 75):  # a family of near copies
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(1000)}"
        out.append((i, " ".join(words), "en", "s0", i))
    out += [(i, out[3][1], "de", "s1", i) for i in range(75, 80)]
    out += [(80, None, "en", "s0", 0), (81, "", "en", "s0", 0), (82, " \t\n", None, None, None), (83, "1234 !!", "de", "s2", 7), (84, "x", "en", "s1", 1), (85, "a b c d", "en", None, 7), (86, "A b C d", None, "s1", 7)]
    out += [(87, prose(rng, "en", 9000), "en", "s0", 0), (None, out[5][1], "de", "s1", 1), (88, "İstanbul under the MIT License K", "en", "s1", 1), (84, "x", "en", "s1", 1)]
    return out


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DDL).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DDL)
