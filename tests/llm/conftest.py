import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, score double, h string, row string, spans string"
WORDS = "time river stone light garden winter music letter window forest silver engine paper bridge summer ocean market village teacher doctor".split()


def prose(seed: int, n: int) -> str:
    """Words that differ from seed to seed."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + "abcdefghij"[(x >> 16) % 10] + "klmnopqrst"[(x >> 20) % 10])
    return " ".join(out)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls anywhere, empty and very long texts, repeated rows, copies; columns whose names clash with results."""
    a, b = prose(1, 120), prose(2, 80)
    rows = [
        (1, a), (2, a), (2, a), (3, b), (4, ""), (5, None), (None, a), (None, None), (6, " \n\t "), (7, "one"), (8, "one two"),
        (9, "x" * 200_000), (10, "\n".join(prose(k % 7, 9) for k in range(4000))), (11, "é漢字 \u00a0 ünïcödé"), (12, a.upper()), (13, b + " tail"),
    ]
    return spark.createDataFrame([(i, t, None if i is None else "en", "s", 0, 1, 0.5, "h", "r", "s") for i, t in rows], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
