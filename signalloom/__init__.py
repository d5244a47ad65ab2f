"""Telemetry and edge-protection data work as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python workers get the few functions that run in them with the task, so the
# package needs no installation on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
