import pytest

from odd import ODD_ROWS, ODD_SCHEMA


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(ODD_ROWS, ODD_SCHEMA).repartition(3)
