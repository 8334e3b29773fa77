"""Batch jobs that prepare, link, encode, split and judge machine-learning tables on Spark."""

import sys

from pyspark import cloudpickle

# What runs in tasks is sent with its code, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
