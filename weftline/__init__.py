"""Data-analysis operators as plain functions from DataFrame to DataFrame."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry this package's helpers with them, so the package
# need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
