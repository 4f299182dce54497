"""Operators for training-data pipelines over document, embedding and conversation tables.

Functions that run on executors are sent by value, so the workers need the
third-party libraries but not this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
