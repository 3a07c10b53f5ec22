import pytest
from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[4]").appName("millrace-tests")
               .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    return session


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
