"""PySpark-native telemetry analytics: privacy rules, windowed tallies, span trees and delivery accounting."""

import sys

from pyspark import cloudpickle

from telemetry_spark.config import Config

# Helpers that run in Python workers travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Config"]
