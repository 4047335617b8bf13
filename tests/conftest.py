import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from example_rows import ACTIONS  # noqa: E402

from linkweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # Many short jobs: few partitions, and no generated code (the oracle check runs with it).
    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.codegen.wholeStage": "false",
    }
    session = local_session(8, **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def example_log(spark):
    from pyspark.sql import functions as F

    rows = [(n, *row) for n, row in enumerate(ACTIONS)]
    return spark.createDataFrame(
        rows, "seq bigint, user_id string, action string, item_id string"
    ).withColumn("ts", F.col("seq"))


@pytest.fixture
def example_files(tmp_path):
    """The example log as comma/CRLF and as tab/bare-CR text, without a last line end."""
    folder = tmp_path / "logged"
    folder.mkdir()
    csv = "\r\n".join(",".join(row) for row in ACTIONS)
    tsv = "\r".join("\t".join(row) for row in ACTIONS)
    (folder / "action-logs.csv").write_bytes(csv.encode())
    (folder / "action-logs.tsv").write_bytes(tsv.encode())
    return folder
