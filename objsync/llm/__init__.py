"""Operators of a training-data pipeline on text, vectors and web pages.

Worker functions travel by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
