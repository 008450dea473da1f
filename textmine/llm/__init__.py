"""Operators for preparing training data: decontamination, deduplication, filters, mixing, archives.

Rows are documents. Unless an operator says otherwise, a row is known by its id together with a hash
of its text, so repeated rows and null ids keep a result of their own.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the task, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
