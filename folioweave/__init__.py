"""Spark-native document corpus, passage retrieval and corpus analytics."""

import sys

from pyspark import cloudpickle

# Row helpers travel to Python workers by value, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
