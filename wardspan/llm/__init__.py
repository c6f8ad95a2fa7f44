"""Operators that prepare text corpora for training large models."""

import sys

from pyspark import cloudpickle

# Executors get these functions by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
