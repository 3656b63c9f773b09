"""Preparation and evaluation of parallel text as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

from seqprep.options import PrepOptions
from seqprep.session import local_session

# The few Python functions that run in tasks travel by value, so executors need
# no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["PrepOptions", "local_session"]
