"""Operators for preparing training text: extraction, filters, de-duplication,
search, redaction and mixing.  Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Executors get these modules with each task, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
