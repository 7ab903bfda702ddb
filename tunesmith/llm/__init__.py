"""Training-data operators: extraction, near duplicates, classifiers, decontamination,
secret scans, tokenisation and sharding.  Nothing else in the library imports this.

The functions that run inside tasks are shipped by value, so that workers do not need
the package on their own import path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
