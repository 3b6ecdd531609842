"""Marketplace order analytics expressed as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

from mercato.market import Market

# executors need not have this package on their path: functions travel with their code
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Market"]
