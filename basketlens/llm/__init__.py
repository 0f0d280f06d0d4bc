"""Operators for preparing text corpora (see README, "Corpus operators").

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries when it can be imported.
"""

import sys

from pyspark import cloudpickle

# Tasks get these functions by value, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
