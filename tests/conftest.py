import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cif_lake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", partitions=2, memory="4g")
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture(scope="session")
def source(spark):
    """Source frame of in-code CIF texts ``{path: text}``, in order."""

    def make(texts):
        texts = {"f.cif": texts} if isinstance(texts, str) else texts
        rows = [(n, path, text) for n, (path, text) in enumerate(texts.items())]
        return spark.createDataFrame(rows, "file_ord int, path string, content string")

    return make
