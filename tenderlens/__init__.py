"""Anomaly analytics over public-procurement notices, written as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
