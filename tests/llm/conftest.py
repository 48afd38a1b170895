from __future__ import annotations

import random

import pytest

from forespell.llm.ship import ship

WORDS = "the of and river stone light morning window quiet letter green market number paper bridge garden winter answer silver motion".split()


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def prose():
    """Random sentences; ``prose(seed, n)``."""

    def made(seed: int, n: int) -> str:
        draw = random.Random(seed)
        return " ".join(f"{draw.choice(WORDS)}{draw.randint(0, 300)}" if draw.random() < 0.6 else draw.choice(WORDS) for _ in range(n))

    return made


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use inside."""

    def made(rows):
        rows = [(i, t, 7, "x", 1.5, [1], "y") for i, t in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, n long, node string, score double, bands array<long>, label string")

    return made
