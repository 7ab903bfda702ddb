"""Spark jobs for the data side of language-model post-training."""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Functions of this package that run inside tasks are shipped by value, so that workers
# need not have the package on their own import path.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
