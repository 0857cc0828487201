"""Training-data operators: deduplication, fingerprints, language, formatting, archives, packing.

The functions that run in tasks travel with them by value, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
