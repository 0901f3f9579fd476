"""Operators for preparing training data: text, archives, vectors and packing.

Functions of these modules travel to the executors by value, so the package need not be
installed there.
"""

from pyspark import cloudpickle

from galley.llm import alignment, common, forest, graph, infill, jaccard, language, lattice, neardup, packing, pii, repeats, unigram, url_lists, vectors, warc

for _module in (alignment, common, forest, graph, infill, jaccard, language, lattice, neardup, packing, pii, repeats, unigram, url_lists, vectors, warc):
    cloudpickle.register_pickle_by_value(_module)
