import random

import pytest

SYLLABLES = {"en": "the and ing ion er re th st of at", "de": "ung sch ein und ver ich ge er", "es": "cion que los ado ar de la o"}


def prose(seed, n, lang="en"):
    draw, parts = random.Random(seed), SYLLABLES[lang].split()
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_texts():
    """(doc_id, text): null, empty and very long texts, copies, near copies, a shared passage, odd characters."""
    base, passage = prose(1, 120), prose(2, 60)
    changed = base.split()
    changed[60] = "altered"
    texts = [base, base, " ".join(changed), None, "", "   \n", "one", "two words", "a b c d", "a b c d e",
             passage, f"{prose(3, 40)} {passage} {prose(4, 30)}", f"{passage}{prose(5, 50)}", base.upper(),
             "naïve Ünïcode 日本語 😀 é\x1c x y " * 12, "x" * 300, "xy" * 100, prose(6, 9000), prose(6, 9000) + " end"]
    return [(i * 3 + 1, t) for i, t in enumerate(texts)]


#: Columns whose names the operators use themselves.
EXTRA = "7 AS n, 'c' AS k, 'p' AS part, 1 AS token, array(1) AS tokens, 'q' AS component, 2 AS node, 3 AS attempts, 4 AS times"


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows, schema="doc_id long, text string", extra=True):
        made = spark.createDataFrame(rows, schema)
        return made.selectExpr("*", *EXTRA.split(", ")) if extra else made
    return make
