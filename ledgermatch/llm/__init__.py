"""Operators for preparing training corpora: one module per operator.

Nothing else in the library imports this subpackage. The registered queries
are in ``queries.py``, their DuckDB statements in ``oracle.py``.
"""

import sys

from pyspark import cloudpickle

# functions that run in Python workers are sent by value: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
