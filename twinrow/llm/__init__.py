"""Operators for training-data pipelines, with the queries that apply them.

Nothing else in the library imports this package. Its functions are shipped to
the executors by value, so these need no copy of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
