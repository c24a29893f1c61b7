import random

import pytest


@pytest.fixture
def words():
    """Invented words by a fixed seed."""
    rng = random.Random(7)
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(400)]


@pytest.fixture
def tables(tmp_path):
    """Write small tables the way the queries read them; returns the folder."""

    def put(spark, **frames):
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return put
