"""Training-data operators: dedup, quality, decontamination, extraction, mixing, scoring.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; ``llm.catalog`` registers one query
per operator.  Functions that run inside tasks are shipped by value, so
executors need only numpy, pyarrow and xxhash, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
