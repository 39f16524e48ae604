"""llm: ten operators that prepare text corpora for training, and their queries.

Nothing else in the library imports this subpackage. Functions that run inside
Spark's Python workers are pickled by value, so executors need no copy of the
repository on their import path.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
