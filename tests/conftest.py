import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfspark.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return get_spark("local[4]", shuffle_partitions=4)


def rows(df, *cols):
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
