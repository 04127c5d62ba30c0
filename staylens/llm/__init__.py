"""Operators for large training-data pipelines. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
