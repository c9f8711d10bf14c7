import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from medledger.plans.demo import claims_lake  # noqa: E402
from medledger.session import build_session  # noqa: E402
from medledger.sources.lake import Lake  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[8]", 2, "6g", app="medledger-tests")
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def claims(spark):
    return claims_lake(spark, SF_DIR)


@pytest.fixture()
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture(scope="session")
def frame(spark):
    """rows -> DataFrame of text columns."""
    def make(columns: str, rows):
        names = columns.split()
        return spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"`{n}` string" for n in names))
    return make
