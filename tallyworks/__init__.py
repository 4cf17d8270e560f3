"""Reporting, profiling, experiment statistics, ingestion and text
classification as plain Spark DataFrame jobs."""


import sys

from pyspark import cloudpickle

# functions that run on workers travel by value: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
