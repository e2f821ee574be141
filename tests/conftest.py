import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from marquee.session import local_session

    return local_session("tests", cores=4, shuffle_partitions=4)


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def big_user(spark):
    """Ratings where user 1 and movie 7 each hold about a third of the rows,
    with tied timestamps and repeated rows."""
    import random

    from marquee.durable import written

    rng = random.Random(5)
    rows = []
    for i in range(1500):
        user = 1 if rng.random() < 0.34 else rng.randint(2, 60)
        movie = 7 if rng.random() < 0.34 else rng.randint(1, 40)
        rows.append((user, movie, rng.randint(1, 10) / 2, rng.randint(0, 90) * 3600, i // 2))
    rows += rows[:20]
    return written(spark.createDataFrame(rows, "userId bigint, movieId bigint, rating double, timestamp bigint, line int"), "big")
