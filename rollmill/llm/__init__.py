"""Operators of a training-data pipeline over documents, embeddings and a benchmark."""

import sys

from pyspark import cloudpickle

# functions travel to the executors by value: those need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
