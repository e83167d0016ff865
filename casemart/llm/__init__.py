"""Training-data operators: one module per operator, queries in `queries`, SQL in `oracle`."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel by value, so workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
