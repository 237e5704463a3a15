"""Curate, embed, map and explore text corpora with Spark."""

import sys

from pyspark import cloudpickle

# Functions run in Python workers travel with their code, so executors need no copy of
# this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
