"""Operators that prepare training data: deduplication, scoring, mixing, packing, fingerprints, PII."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors with their tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
