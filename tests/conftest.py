import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ratingloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "tests", 4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def ratings(spark):
    """Pseudo-random ratings in which one item and one user hold a large share of the rows."""
    rows = []
    for u in range(40):
        rows.append((f"u{u:02d}", "hot", float(u * 7 % 5 + 1)))
        for i in range(12):
            if (u * 31 + i * 17) % 3 == 0 or u == 0:
                rows.append((f"u{u:02d}", f"i{i:02d}", float((u * 13 + i * 5) % 5 + 1)))
    return spark.createDataFrame(rows, "user_id string, parent_asin string, rating double")
