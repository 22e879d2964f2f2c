"""Operators for large training corpora; nothing else in the library imports them.

The functions that run in Python workers travel with the job, so workers need no copy
of this package.
"""

from pyspark import cloudpickle

import termloom.llm as _package

cloudpickle.register_pickle_by_value(_package)
