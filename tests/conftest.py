import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[2]")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def blobs(spark):
    """400 labelled rows of four features, two of which carry the class."""
    import numpy as np
    import pandas as pd

    random = np.random.default_rng(7)
    x = random.normal(size=(400, 4))
    y = (x[:, 0] + x[:, 1] > 1.0).astype(float)
    table = pd.DataFrame(x, columns=list("abcd")).assign(id=np.arange(400), label=y)
    return spark.createDataFrame(table)
