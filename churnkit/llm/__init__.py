"""Operators of a training-data pipeline: quality, packing, near-duplicates, language, decontamination, extraction,
language models, URL rules, clustering, conversation tries, personal data.

Nothing else in the library imports this subpackage.  Task functions are
pickled by value, so executors need no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
