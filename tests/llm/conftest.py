import random

import pytest

SYLLABLES = "ba be bi bo bu da de di do du ka ke ki ko ku la le li lo lu ma me mi mo mu na ne ni no nu".split()


@pytest.fixture
def rnd():
    return random.Random(7)


@pytest.fixture
def words(rnd):
    """A maker of random texts."""
    def make(n: int) -> str:
        return " ".join("".join(rnd.choice(SYLLABLES) for _ in range(rnd.randint(1, 4))) for _ in range(n))
    return make


@pytest.fixture
def empty(spark):
    """An empty table of a schema."""
    return lambda schema: spark.createDataFrame([], schema)
