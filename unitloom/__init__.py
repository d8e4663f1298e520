"""unitloom: document-unit analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so a worker needs no copy of this package on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
