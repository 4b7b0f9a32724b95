import pytest
from tradeflow.llm.storage import Store


@pytest.fixture
def checkpoint_store(spark):
    return Store(spark)
