"""Operators for preparing training text: filtering, tokens, packing, shards, near-copies."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the tasks, so no executor needs a copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
