"""Training-data operators: language ID, scoring, deduplication, search, mixing and packing.

Nothing outside this folder imports it.  On a cluster ship the package with
``--py-files`` so that executors can import it.
"""
