import pytest

from rostra.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    """Workers started elsewhere than in the repository find the package as well."""
    ship(spark)
