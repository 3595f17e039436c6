"""Training-data operators: packing, dedup, quality, tokens, scoring, extraction.

Nothing else in the package imports this one.  Functions that run inside tasks
are pickled by value, so executors need no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
