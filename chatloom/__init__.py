"""Chat and preference data preparation on Spark.

The package is a set of DataFrame operators: read, transform, filter, mix, render,
tokenize, pack, and report. See the README for a tour.
"""

from pyspark import cloudpickle as _cloudpickle

import chatloom.operators  # noqa: F401

# Functions that run in Python workers travel by value: executors need no installed copy.
_cloudpickle.register_pickle_by_value(__import__(__name__))

__version__ = "0.1.0"
