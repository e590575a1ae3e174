"""Spark analytics for on-chain lending positions and token transfers."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with the query, so executors
# need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
