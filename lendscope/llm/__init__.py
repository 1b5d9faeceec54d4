"""Operators for large training-text corpora: search, scoring, packing, dedup.

Functions of this subpackage are shipped to the executors by value, so a
cluster's workers need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
