import json
import os

import pytest

from tidegauge.session import engine_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.master": "local[4]",
        "spark.sql.shuffle.partitions": "2",
        "spark.default.parallelism": "2",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    }
    session = engine_session("tests", **conf)
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def drop_file(tmp_path):
    """Writes JSON lines as one file of a source folder; files count in call order."""
    folder = tmp_path / "source"
    folder.mkdir()
    count = iter(range(10_000))

    def write(*lines):
        n = next(count)
        path = folder / f"part-{n:04d}.txt"
        texts = [x if isinstance(x, str) else json.dumps(x) for x in lines]
        path.write_text("\n".join(texts) + "\n")
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))

    write.folder = str(folder)
    return write


def reading(device, clock, value):
    return {"device_id": device, "value": value, "timestamp": f"2024-01-01T{clock}Z"}
