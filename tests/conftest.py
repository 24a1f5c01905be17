import os
import sys

for _v in ("OPENBLAS_NUM_THREADS", "OMP_NUM_THREADS", "MKL_NUM_THREADS"):
    os.environ.setdefault(_v, "1")

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from listing_yield.session import build_session
    s = build_session("tests", cpus="*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def ev(spark):
    """Evaluate a column function over literal strings; returns the results in order."""
    def run(fn, values, dtype="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")
        rows = df.select("i", fn("x").alias("r")).orderBy("i").collect()
        return [r["r"] for r in rows]
    return run
