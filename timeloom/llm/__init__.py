"""Operators for large training-data pipelines.

Nothing else in the library imports this subpackage; its queries are in
``timeloom.llm.queries`` and its tests in ``tests/llm``."""

import sys

from pyspark import cloudpickle

# Task functions travel with their helpers, so executors need not have the
# package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
