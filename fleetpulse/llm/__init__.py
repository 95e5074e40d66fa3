"""Operators for building language-model training data, and their registered queries.

Functions of this folder travel to the executors by value, so that those need not have
it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
