import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from stratascore.session import build_session

    return build_session("tests", cpus=8, memory="8g")


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def wide(spark):
    """400 rows with a signal, a rare label and three loose segments."""
    import numpy as np

    rng = np.random.RandomState(3)
    n = 400
    seg = rng.randint(0, 3, n)
    a = rng.normal(size=n) + 4 * seg
    b = rng.normal(size=n) - 3 * seg
    c = rng.exponential(size=n) * 1000
    label = (a - 4 * seg + 0.3 * rng.normal(size=n) > 1.1).astype(int)
    rows = [(i, int(label[i]), int(seg[i]), float(a[i]), float(b[i]), float(c[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id bigint, label int, seg int, a double, b double, c double")
    return df.repartition(5).persist()
