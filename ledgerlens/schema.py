"""Column names and types of a labelled transaction table."""

from pyspark.sql import types as T

COMPONENTS = [f"V{i}" for i in range(1, 29)]

# The inputs of every model, of the projection and of the clustering.
MODEL_FEATURES = COMPONENTS + ["Amount"]

# Correlation and box plots describe one component fewer than the models use.
PROFILE_FEATURES = COMPONENTS[:27]

TRANSACTIONS = T.StructType(
    [T.StructField("Time", T.DoubleType())]
    + [T.StructField(name, T.DoubleType()) for name in MODEL_FEATURES]
    + [T.StructField("Class", T.IntegerType())]
)


def keyed(key: str = "event_id") -> T.StructType:
    """The transaction schema with a leading unique key."""
    return T.StructType([T.StructField(key, T.LongType())] + TRANSACTIONS.fields)
