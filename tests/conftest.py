import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from annalist.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "2",
            # The inputs are tiny: compiling the plans would cost more than running them.
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
