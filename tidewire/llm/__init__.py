"""Operators of a training-data pipeline over the tables `documents`, `pages` and `conversations`.

Each module holds one operator with its own interface; `queries` derives the registered queries
from them. Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Tasks get the operators' functions by value, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
