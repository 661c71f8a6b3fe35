import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")

from corvane.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g", spark__driver__host="127.0.0.1",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")), spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")), spark__ui__showConsoleProgress="false",
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
