"""Operators for training-data pipelines over tables of documents.

Nothing else in the library imports this subpackage. Its functions travel to the
executors by value, so they need no copy of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
