"""Operators for preparing training text; nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# functions of this package go to executors by value: they need not have it installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
