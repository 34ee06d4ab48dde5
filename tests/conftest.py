import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from likewise.plans.session import local_session
    session = local_session(cores=4, shuffle_partitions=8, app_name="likewise-tests")
    yield session
    session.stop()


def flat_frame(spark, rows, names, id_type="string"):
    """A flat catalog from Python rows ``(sku, v1, ..., vm)``."""
    schema = f"sku {id_type}, " + ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame(rows, schema)
