"""Terrawave: array time-series transfer functions and table analytics on Spark."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry this package's code with them; executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
