"""Operators for preparing training text. Nothing else in the library imports this subpackage.

Its Python functions travel to the executors by value, so that these need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
