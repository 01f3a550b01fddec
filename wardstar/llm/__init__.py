"""Operators for preparing training text: scans, deduplication, scoring, mixing and sharding.

Functions that run inside Python workers travel by value, so executors need no copy of
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
