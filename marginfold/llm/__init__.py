"""Operators for preparing text to train language models; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their code, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
