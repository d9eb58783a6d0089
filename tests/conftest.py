import os
import sys
from datetime import date

import pytest
from pyspark.sql import SparkSession, types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfcast.params import Params
from shelfcast.session import with_settings
from shelfcast.sources.readers import empty_source
from shelfcast.sources.schemas import SCHEMAS

AS_OF = date(1998, 3, 2)


@pytest.fixture(scope="session")
def spark():
    session = (
        with_settings(SparkSession.builder.master("local[8]"))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def params():
    return Params(AS_OF)


@pytest.fixture
def source(spark):
    """A source table out of rows that name only the columns they fill."""

    def build(name, *rows):
        schema = T.StructType.fromDDL(SCHEMAS[name])
        return spark.createDataFrame([tuple(row.get(c) for c in schema.names) for row in rows], schema)

    return build


@pytest.fixture
def sources(spark, source):
    """All sources, empty but for those given."""

    def build(**tables):
        return {name: tables.get(name, empty_source(spark, name)) for name in SCHEMAS}

    return build
