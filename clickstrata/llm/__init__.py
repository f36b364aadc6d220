"""Operators for preparing training data."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need
# the libraries these operators use but no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
