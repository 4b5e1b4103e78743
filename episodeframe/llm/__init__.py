"""Training-data operators: classification, filtering, near-duplicates, mixing, packing, archives."""

import sys

from pyspark import cloudpickle

# Functions of these modules travel with the plan: executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
