"""Climate-risk analytics on Spark: climatology, indices, triggers, payouts and pricing as DataFrame plans."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, which need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
