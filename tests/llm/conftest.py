import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_spark
    s = get_spark(cores=4, shuffle_partitions=4, driver_memory="4g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def docs_rows(spark):
    """Rows of the small documents table, by id."""
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
