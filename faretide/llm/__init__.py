"""Operators for preparing training text. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Executors get this package's functions with each job, so nothing is installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
