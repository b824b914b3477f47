"""Quantitative panel analytics on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package travel with their tasks, so executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
