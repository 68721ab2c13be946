"""Operators for training-data pipelines: sharding, near-duplicates, token
counts, byte-level BPE, chat repair, token-id files, decontamination, exact
top-k search, page text extraction and toxicity scores. Nothing outside this
subpackage imports it."""

import sys

from pyspark import cloudpickle

# Tasks carry the functions they run, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
