import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("TZ", "UTC")
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import session

    return session("tests", master="local[8]", partitions=8)


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture(scope="session")
def duck():
    """A DuckDB connection with a view on each table."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(DATA):
        path = f"{DATA}/{name}"
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{path if os.path.isfile(path) else path + '/*.parquet'}'")
    return con


def rows_of(frame):
    """Rows of a pandas frame with columns by name, as comparable tuples."""
    import numpy as np
    import pandas as pd

    def plain(x):
        if x is None or (not isinstance(x, (list, np.ndarray)) and pd.isna(x)):
            return "null"
        if isinstance(x, (bool, np.bool_)):
            return str(bool(x))
        if isinstance(x, (pd.Timestamp, np.datetime64)):
            return str(pd.Timestamp(x))
        if hasattr(x, "isoformat"):
            return str(pd.Timestamp(x))
        try:
            return f"{float(x):.9g}" if not isinstance(x, str) else x
        except (TypeError, ValueError):
            return str(x)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(plain, row)) for row in frame.itertuples(index=False))
