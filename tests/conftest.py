import pytest

from tests.compare import duckdb_tables, local_spark

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_spark()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture(scope="session")
def tables():
    return duckdb_tables(SMALL)
