"""Operators for preparing training data: deduplication, scoring, tokenising, mixing, search."""

import sys

from pyspark import cloudpickle

# Code of this subpackage travels to the Python workers with the job, so they need not
# have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
