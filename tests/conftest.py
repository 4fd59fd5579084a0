import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from simplexa import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "6g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample_run(spark):
    """Counts of six samples in two treatments, and their metadata.

    Fixed values: the pinned results of the tests belong to them.
    """
    counts = {
        "S1": [10, 0, 5, 20, 0], "S2": [12, 1, 6, 19, 0], "S3": [11, 0, 5, 21, 1],
        "S4": [0, 20, 1, 5, 10], "S5": [1, 22, 0, 4, 12], "S6": [0, 19, 2, 6, 11],
    }
    names = ["Feat_A", "Feat_B", "Feat_C", "Feat_D", "Feat_E"]
    long = spark.createDataFrame(
        [(s, f, float(v)) for s, row in counts.items() for f, v in zip(names, row)],
        "Sample string, FeatureID string, Value double",
    )
    metadata = spark.createDataFrame(
        [("S1", "Control", 7.0), ("S2", "Control", 7.1), ("S3", "Control", 6.9),
         ("S4", "Stress", 5.5), ("S5", "Stress", 5.4), ("S6", "Stress", 5.6)],
        "Sample string, Treatment string, pH double",
    )
    return long, metadata
