"""Operators of a training-data pipeline: filters, deduplication, scans, token output.

Functions of this package travel to the Python workers by value, so a cluster needs
no copy of the package on its executors. Broadcast values are plain data for that reason.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
