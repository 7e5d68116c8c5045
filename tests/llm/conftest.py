import re

import pytest

# Columns whose names the operators use inside.
ODD = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, row string, "
    "items string, spans string, node long, copy long, n long, words string, _text string, y string"
)
LONG = " ".join(f"w{k % 977}x{k}" for k in range(30_000))


def extra(doc_id, text):
    return (doc_id, text, "en", None, None, 0.1, "r", "i", "s", 1, 2, 3, "w", "t", "y")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and blank texts, a very long one, repeated rows, a row without id."""
    data = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (5, LONG), (6, LONG),
            (None, "a text without any id at all"), (7, "a text without any id at all")]
    return spark.createDataFrame([extra(*d) for d in data], ODD)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], ODD)


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
