"""Operators that prepare text corpora for language-model training.

Functions that run in tasks are shipped by value, so executors need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
