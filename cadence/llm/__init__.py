"""Operators for preparing training data. Nothing else in the library imports this.

Functions that run in Python workers travel by value, so executors need the
third-party packages only, not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
