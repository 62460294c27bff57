"""Operators that prepare a text corpus for training, with their queries and SQL."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel to Python workers by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
