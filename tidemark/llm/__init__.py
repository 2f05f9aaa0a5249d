"""Operators for large text corpora. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel whole, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
