import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fasor.session import sessao  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return sessao(
        "testes",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="fasor-testes-"),
        },
    )
