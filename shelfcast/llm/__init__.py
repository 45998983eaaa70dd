"""Training-data operators: quality, deduplication, decontamination, scoring, packing.

Each module holds one operator with a general DataFrame interface; ``queries.py``
binds the operators to the test tables as the registered ``opN_<name>`` queries.
"""
