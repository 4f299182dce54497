import pytest

from tests.llm import tables


@pytest.fixture(scope="session")
def awkward(spark, tmp_path_factory):
    return tables.write(spark, str(tmp_path_factory.mktemp("awkward")))


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return tables.write(spark, str(tmp_path_factory.mktemp("empty")), empty=True)
