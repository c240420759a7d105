"""Operators that prepare text corpora for language-model training.

Each module holds one operator with a general interface; ``queries`` applies them to
the ``documents`` and ``pages`` tables.  Functions that run inside tasks are shipped
with their code, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
