"""Customer analytics operators on the Spark DataFrame, SQL and ML APIs."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel whole, so workers need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
