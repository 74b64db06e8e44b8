"""Operators that prepare text corpora for training. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job; the package need not be installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
