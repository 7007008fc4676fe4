"""Retail data integration and sales analytics as PySpark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Python workers get the package's functions by value: executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
