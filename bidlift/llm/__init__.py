"""Operators of a training-data pipeline: filters, deduplication, packing, sharding, token files.

The functions that run in Python workers are sent with the job, so that workers
need the installed libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
