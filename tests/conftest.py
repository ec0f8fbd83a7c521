import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent.parent))

from gleanfield.operators.gazetteer import Gazetteer  # noqa: E402
from gleanfield.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("checkpoint")
    session = local_session("4", 4, **{"spark.checkpoint.dir": str(folder)})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def gazetteer(spark):
    return Gazetteer.default(spark)


@pytest.fixture(scope="session")
def column(spark):
    """Apply a column function to a list of strings."""

    def apply(fn, values):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        rows = df.select("i", fn(df["v"]).alias("out")).collect()
        return [r["out"] for r in sorted(rows, key=lambda r: r["i"])]

    return apply
