"""Spark operators for the data side of building and auditing sample pools."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to Python workers travel with the job, so executors need no installation.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
