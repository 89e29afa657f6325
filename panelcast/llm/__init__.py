"""Operators of a training-data pipeline: deduplication, archives, sharding, mixing, language ID.

Nothing else in the library imports this subpackage.  Functions that run in Python workers are
sent by value, so that executors need no copy of the library on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
