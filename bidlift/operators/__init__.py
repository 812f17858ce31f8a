"""Operators: DataFrames in, DataFrames out.

Passes that run in Python workers are sent with the job, so that workers need
numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
