import random

import pytest

SMALL = "/root/testdata/sf0.001"
#: Columns of a documents table, and some more whose names the operators use inside.
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = "label string, part string, size string, tie string, h string, c string, copies string, id string, n string, spans string"


def _rows():
    rnd = random.Random(3)
    words = [f"{a}{b}" for a in ("ka", "lo", "mé", "ti", "zu") for b in ("ran", "ben", "st", "ö", "x.", "")]
    long = " ".join(rnd.choice(words) for _ in range(20_000))
    middle = " ".join(rnd.choice(words) for _ in range(120))
    edited = middle.split()
    edited[60] = "changed"
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "one"),
        (5, "ONE two"),
        (None, "no id here but words"),
        (None, None),
        (6, long),
        (7, long + " and one more"),
        (8, middle),
        (9, " ".join(edited)),
        (10, middle),
        (10, middle),
        (11, "x" * 900),
        (12, "ab" * 300 + middle[:250]),
        (11, "another text with the same id"),
        (13, "tail " + middle[-260:]),
        (14, middle[:199]),
    ]


@pytest.fixture(scope="session")
def edge_rows():
    """Null ids and texts, empty and very long texts, copies, near copies, repeated rows and ids."""
    return _rows()


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    wide = [(d, t, "en", None if d is None else "ab"[d % 2], None if d == 4 else len(t or ""), *"clashing!x") for d, t in edge_rows]
    return spark.createDataFrame(wide, f"{DOCS}, {EXTRA}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], f"{DOCS}, {EXTRA}")


@pytest.fixture(scope="session")
def small(spark):
    return lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet")


@pytest.fixture(scope="session")
def pairs():
    """doc_id and text of a documents table."""
    return lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def bag():
    """Rows in an order of their own, for comparison; nulls first."""
    return lambda rows: sorted((tuple(r) for r in rows), key=lambda r: [(x is not None, x) for x in r])
