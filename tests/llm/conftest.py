import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from samples import DOC, FOLDER, ODD  # noqa: E402


@pytest.fixture
def odd(spark):
    """Odd rows, with further columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    extra = ["row", "words", "size", "kept", "part", "rate", "mix", "shard", "c", "maybe"]
    return spark.createDataFrame(ODD, DOC).withColumns({n: F.lit(7) for n in extra})


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")
