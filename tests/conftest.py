import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from heliotab.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = f"file://{tmp_path_factory.mktemp('shared')}"
    session = get_session("tests", "local[8]", {"spark.checkpoint.dir": shared, "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """frame(rows, ddl): a DataFrame; text in timestamp columns is parsed as UTC."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    def make(rows, ddl):
        schema = T.StructType.fromDDL(ddl)
        loose = T.StructType(
            [T.StructField(f.name, T.StringType() if f.dataType.typeName() in ("timestamp", "date") else f.dataType) for f in schema]
        )
        df = spark.createDataFrame(rows, loose)
        return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])

    return make
