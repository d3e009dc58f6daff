import os
import sys

import pytest

sys.path.append(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session", autouse=True)
def importable(spark):
    from segrec.llm.common import ensure_importable

    ensure_importable(spark)


@pytest.fixture
def model():
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture
def frame(spark):
    """rows -> DataFrame that is spread over several partitions."""
    return lambda rows, schema, parts=3: spark.createDataFrame(rows, schema).repartition(parts)
