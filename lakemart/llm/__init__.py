"""Operators for large text corpora: deduplication, filtering, scoring, packing, search, archives.

Nothing outside this folder imports it. Its task functions travel to the executors by value, so a
cluster needs no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
