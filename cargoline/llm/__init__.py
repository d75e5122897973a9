"""Operators of a training-data pipeline; nothing outside this package imports it.

Functions that run inside tasks are shipped by value, so executors need the
third-party libraries but no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
