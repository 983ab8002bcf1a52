"""Operators of a training-data pipeline: dedup, filters, mixing, formatting, output.

Functions that run in Python workers are shipped by value, so a cluster's
workers need numpy, pyarrow and the tokenizer libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
