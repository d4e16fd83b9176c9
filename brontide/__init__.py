"""Brontide: market-microstructure analytics as PySpark DataFrame operations."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel whole, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
