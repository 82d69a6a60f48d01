"""Operators of a training-data pipeline. Functions run in Python workers travel with the job, so executors need no copy of this."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
