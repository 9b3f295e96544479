import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (SparkSession.builder.master("local[8]").appName("leadloom-tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
               # tiny tables: compiling a stage costs more than running it
               .config("spark.sql.codegen.wholeStage", "false")
               .config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
