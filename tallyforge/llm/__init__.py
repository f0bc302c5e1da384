"""Operators for preparing language-model training text, and the queries that apply them.

Functions that run inside Python tasks are sent to the executors by value, so that executors need
not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
