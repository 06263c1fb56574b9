"""Batch analytics on PySpark DataFrames: roster cleaning, linkage, auditing and text corpora.

The package is shipped to executors by value, so a cluster needs no installation step.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
