"""Time-stamped acoustic and time-series features as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# The Arrow kernels travel to the Python workers by value, so a cluster needs nothing but
# pyspark, numpy and pyarrow on its executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
