import pytest

from skyledger.llm import common


@pytest.fixture(autouse=True)
def _workers(spark):
    common.workers_see_package(spark)
    common.checkpoint_dir(spark)
