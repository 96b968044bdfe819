"""Operators on text corpora for training data."""

import sys

from pyspark import cloudpickle

# Tasks carry the code of this subpackage with them, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
