import random

import pytest

EXTRA = "lang string, source string, n_chars long, chunk int, keep_id string, `rank` string, h1 string, rep string, row int"


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text): nulls, empty and long texts, ties, repeated rows, texts that share passages."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["re", "an", "tion", "é", "wh", "ST", "x"]) for _ in range(rng.randint(1, 4)))
    passage = " ".join(word() for _ in range(40))
    rows = [(1, None), (2, ""), (3, "  \t\n"), (4, "one"), (5, "one two three"), (6, "one"), (6, "one"), (None, "one"),
            (None, None), (None, "only without an id"), (None, "only without an id")]
    for i in range(10, 30):
        text = " ".join(word() for _ in range(rng.randint(5, 120)))
        rows.append((i, text + ("\n" + passage if i % 3 == 0 else "") + (" tail\x1c\x85 é̈ 各" if i % 5 == 0 else "")))
    rows += [(40, rows[15][1]), (41, rows[15][1]), (9, rows[20][1]), (43, "same " * 3000), (44, "same " * 3000 + "end")]
    rows += [(45, " ".join(word() for _ in range(20_000)))]
    return rows


def documents(spark, rows):
    data = [(i, t, "en", "s", 0 if t is None else len(t), 1, "k", "r", "h", "p", 2) for i, t in rows]
    return spark.createDataFrame(data, "doc_id long, text string, " + EXTRA)


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return documents(spark, edge_rows).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return documents(spark, [])
