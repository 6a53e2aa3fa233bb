"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Its task-side functions
travel to the executors with the job, so workers need no copy of the package.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
