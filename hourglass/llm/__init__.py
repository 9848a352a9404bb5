"""Operators for building training corpora. Nothing else in the package
imports this subpackage; ``queries`` registers its queries."""

import sys

from pyspark import cloudpickle

# Task code travels with the task: executors need the libraries that it uses,
# not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
