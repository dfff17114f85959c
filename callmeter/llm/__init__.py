"""Operators that prepare training text."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python workers travel with the job, so
# the executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
