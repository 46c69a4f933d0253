"""Text-intent classification as Spark table and stream jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
