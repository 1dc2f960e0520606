"""stillhouse: Spark-native table work around distilling a large prompted model into a small one."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python functions of this package travel to the executors by value, so only the driver needs it
# installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
