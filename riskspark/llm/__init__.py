"""Operators of a training-data pipeline on text tables: deduplication, filtering, mixing, sharding."""

import sys

from pyspark import cloudpickle

# Executors get the functions themselves, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
