import pytest

#: Columns whose names the operators use themselves.
EXTRA = ("copies", "digest", "node", "key", "label", "score", "run", "part", "doc", "n", "grp")


@pytest.fixture(scope="session")
def odd_rows():
    """Identifiers and texts with nulls, empties, ties, repeated rows, control characters and a long text."""
    long = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
    base = "the quick brown fox jumps over the lazy dog while nine other animals look on in quiet wonder today"
    near = base.replace("nine", "ten")
    return [(1, base), (2, near), (3, base), (3, base), (4, None), (5, ""), (6, ""), (None, base), (None, None),
            (7, "short"), (8, "one two three"), (9, "one two three"), (10, "\0 odd\tspace  twice \r\n end"), (11, long),
            (12, long + " tail"), (13, "é É ß 中文 text"), (14, " "), (15, "\n\n")]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows as documents with columns of clashing names."""
    rows = [(i, t, "en", None if i == 7 else f"s{(i or 0) % 2}", len(t or ""), *([f"{c}!" for c in EXTRA]))
            for i, t in odd_rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"{c} string" for c in EXTRA))


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
