import pytest
from samples import cases, frame


@pytest.fixture(scope="session")
def docs(spark):
    return frame(spark, cases()).repartition(3).persist()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
