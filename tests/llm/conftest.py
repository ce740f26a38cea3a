import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, row string, tag int, n long, data string, _row string, label int, quality int"


def make(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source); further columns have names that operators use inside."""
    full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", 1, 7, "x", 3, 4, "d", "y", 5, 6) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
EDGE = [
    (1, None), (2, ""), (3, " \n\t \x0b\x0c\r"), (4, "one"), (5, "one two"), (6, "a b c d e f g h " * 30), (7, LONG), (8, LONG + " tail"),
    (None, "no key at all, but some words to count and to look at for once"), (10, "no key at all, but some words to count and to look at for once"),
    (11, "dup dup"), (11, "dup dup"), (12, "größe naïve wide \U0001f30a ÀÉ #*$%&|<> !?!"), (13, "line\nline\n\nline\nother"), (14, "<|endoftext|> special <|endoftext|>"), (15, "�\x00 nul"),
]


@pytest.fixture(scope="session")
def edge(spark):
    return make(spark, [(*r, ["s", None, "t", ""][i % 4]) for i, r in enumerate(EDGE)])


@pytest.fixture(scope="session")
def empty(edge):
    return edge.limit(0)
