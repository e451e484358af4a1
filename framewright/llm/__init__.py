"""Training-data operators: quality, packing, records, near-dedup, WARC, URL filter, PII, BPE.

Nothing outside this folder imports it. Each module holds one operator with a
general interface; `queries` binds the operators to the given tables.
"""
