"""Manifest-to-dataset collection as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so the package
# need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
