"""Operators of a training-data pipeline: packing, secret scans, quality,
mixing, chat formatting, toxicity, near-duplicates, line dedup, exact top-k.

Nothing outside this subpackage imports it.  Functions that run in Python
workers are shipped by value, so executors need the installed public libraries
only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
