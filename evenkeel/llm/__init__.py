"""Operators for training-data corpora; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Tasks get these functions by value, so that executors need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
