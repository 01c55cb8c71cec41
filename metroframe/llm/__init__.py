"""Training-data operators on Spark: packing, near-dedup, search, URL filters,
archives, classifiers, tokenization and license scans.

Functions that run inside Python tasks travel to the executors by value, so a
cluster needs no copy of this package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
