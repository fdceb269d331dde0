"""Operators that prepare text corpora for training, and their queries.

Functions of this package that run in tasks travel with the task, so the
executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
