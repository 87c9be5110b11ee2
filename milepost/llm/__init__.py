"""Training-data operators over document and conversation tables."""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this package by value, so workers need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
