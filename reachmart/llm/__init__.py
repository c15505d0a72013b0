"""Operators for preparing training text: dedup, language, toxicity, privacy, mixing, sharding."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the job, so the workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
