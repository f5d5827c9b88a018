"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. ``catalog.QUERIES`` holds
the registered queries, ``catalog.ORACLES`` their DuckDB counterparts.
"""

import sys

from pyspark import cloudpickle

# The functions of this subpackage that run in Python tasks travel with the job: executors need
# numpy, pyarrow, xxhash and the tokenizer libraries, but not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
