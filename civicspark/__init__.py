"""Public-records analytics on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a job also runs where the package isn't installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
