import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, t string, id long, node string, size string, __found string"


def docs_frame(spark, rows):
    """Documents with extra columns whose names operators use inside; rows are (doc_id, text[, lang[, source]])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or ""), "t", 7, None, "x", "f") for r in rows]
    return spark.createDataFrame(full, COLUMNS)


def sentence(rng, n, words=None):
    words = words or [a + b for a in ("ka", "lo", "mi", "re", "su") for b in ("n", "t", "s", "", "ra")]
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, repeated rows, ties, near copies."""
    rng = random.Random(5)
    base = [sentence(rng, 120) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100, None), (101, ""), (102, " \n\t "), (None, base[0]), (None, None), (103, base[1]), (103, base[1]), (104, "one two"), (105, "One two")]
    words = base[2].split()
    words[60] = "changed"
    rows += [(106, " ".join(words)), (107, base[3] + " " + base[4]), (108, sentence(rng, 30000)), (109, "x" * 60000), (103, base[5]), (110, "é" * 40 + " 日本語 " + base[6])]
    return rows
