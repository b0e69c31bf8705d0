"""Operators of a large-scale training-data pipeline (documents, embeddings, web pages).

Nothing else in the library imports this subpackage. Task functions are pickled by value, so
executors need the third-party libraries only, not an installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
