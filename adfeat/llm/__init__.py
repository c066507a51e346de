"""Operators for preparing training text; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Tasks carry this package's functions with them, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
