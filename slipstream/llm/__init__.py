"""Operators for preparing training text at scale. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors with the job, which need not have the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
