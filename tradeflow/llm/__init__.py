"""Operators that prepare text corpora for training language models."""

import sys

from pyspark import cloudpickle

# What runs on executors travels with the job, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
