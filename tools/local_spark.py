"""A one-machine session for the bench and the tools."""
from pyspark.sql import SparkSession

from tabclass.session import ensure_checkpoint_dir

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.driver.memory": "8g",
}


def one_machine(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    settings = SETTINGS | {"spark.master": f"local[{cores}]", "spark.sql.shuffle.partitions": str(shuffle_partitions)}
    spark = SparkSession.builder.config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark
