import pytest

from tests.session import session


@pytest.fixture(scope="session")
def spark():
    # Inputs are tiny: compiling the plans would take longer than running them.
    return session(**{"spark.sql.shuffle.partitions": "2", "spark.sql.codegen.wholeStage": "false"})


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
