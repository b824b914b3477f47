"""Operators of a training-data pipeline; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel with their tasks, so executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
