"""Operators for training-data pipelines; nothing else in the library needs them.

Functions of this package that run in tasks are sent to the workers by value,
so executors need numpy, pyarrow and the tokenizer libraries, but no copy of
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
