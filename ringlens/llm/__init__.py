"""Operators of a training-data pipeline; nothing outside this package imports it.

Its Python functions travel to the executors by value, so only this side needs the package.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
