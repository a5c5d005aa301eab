"""Operators for preparing training data at scale."""

import sys

from pyspark import cloudpickle

# Functions go to the executors by value, so that workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
