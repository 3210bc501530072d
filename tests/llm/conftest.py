import pytest

from slotwise.llm.common import ship

DOCUMENT = "doc_id long, text string"


@pytest.fixture(scope="session")
def make(spark):
    """A documents table of (doc_id, text) rows; with two columns whose names clash with
    those that operators make."""
    ship(spark)

    def build(rows, kind=DOCUMENT):
        return spark.createDataFrame([(*r, "x", 7) for r in rows], kind + ", kept string, h int")

    return build


def words(n, seed, size=900):
    """``n`` invented words."""
    import random

    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(size)}" for _ in range(n))
