import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("larder-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def foods(spark):
    """Build documents from (id, category, source, [(measure id, value), ...])."""
    from larder.sources.schemas import raw_schema

    def build(*rows):
        documents = [
            {
                "fdcId": number,
                "description": f"food {number}",
                "dataType": "Survey (FNDDS)",
                "foodCategory": category,
                "sourceCollection": source,
                "foodNutrients": None
                if entries is None
                else [
                    {"nutrientId": key, "nutrientName": f"n{key}", "unitName": "G", "value": value}
                    for key, value in entries
                ],
            }
            for number, category, source, entries in rows
        ]
        return spark.createDataFrame(documents, raw_schema())

    return build
