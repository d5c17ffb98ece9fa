"""Operators for training-data pipelines: formatting, packing, near-duplicates, scoring, sharding.

Nothing else in the library imports this subpackage. Functions that run inside tasks are pickled
by value, so executors need the public packages only, not this one.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
