"""tallyloom: business analytics expressed as Spark DataFrame operations."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few functions that run inside Python workers travel with their code, so
# that the executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
