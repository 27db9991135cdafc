"""Fraud analytics over labelled transaction tables, built on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
