"""Operators that prepare text for training language models.

Nothing else in the library imports this package; its queries are in
``tillwork.llm.catalogue``. What runs inside tasks is sent along by value, so executors
need the libraries it uses but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
