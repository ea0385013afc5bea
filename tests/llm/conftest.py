import random

import pytest


def words_of(r, n, vocabulary=400):
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty and long texts, repeated rows, near copies, columns with clashing names."""
    r = random.Random(5)
    base = words_of(r, 120)
    rows = [(1, " ".join(base), "en", "a", "x", 1.0), (1, " ".join(base), "en", "a", "x", 1.0), (2, " ".join(base[:-1] + ["zz"]), "en", "a", "y", 2.0), (3, None, None, None, None, None), (4, "", "en", "b", "", 0.0), (None, "no id here at all", "en", "b", "q", 0.0), (None, None, None, None, None, None), (5, " ".join(words_of(r, 30_000)), "fr", "b", "z", 0.5), (6, "... 123 ,", "de", None, "z", 0.5), (7, "two words", "de", "c", "z", 0.5)]
    for k in range(8, 40):
        text = base[:]
        for _ in range(r.randrange(0, 4)):
            text[r.randrange(len(text))] = "edit"
        rows.append((k, " ".join(text if k % 2 else words_of(r, 40)), "en" if k % 3 else "fr", f"s{k % 4}", "lang_pred", 0.1))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, lang_pred string, score double")
