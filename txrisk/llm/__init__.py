"""Operators for preparing language-model training data, one module each."""

import sys

from pyspark import cloudpickle

# Functions sent to tasks carry their code, so executors need not have the
# package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
