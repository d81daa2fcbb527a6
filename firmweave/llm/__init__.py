"""Operators of a training-data pipeline over a table of documents, and their queries.

Functions that run inside tasks travel with them, so executors need numpy, pyarrow and tokenizers but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
