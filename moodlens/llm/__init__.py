"""Operators of a training-data pipeline: extraction, deduplication, filtering, mixing and packing."""

import sys

from pyspark import cloudpickle

# tasks carry this package's functions with them, so executors need not have it installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
