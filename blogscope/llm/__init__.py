"""Training-data operators: scoring, filtering, deduplication, search and packing.

Each module holds one operator with a general interface; ``queries`` registers the
thin ``opN_<name>`` queries. Functions that run inside tasks are pickled by value,
so executors need numpy, pyarrow and the tokenizer libraries but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
