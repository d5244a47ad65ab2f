"""Operators for training corpora: tokens, duplicates, private data, quality, packing.

Nothing else in the library imports this package.  Its Python code runs on
executors, so a cluster needs the library there (``--py-files`` or installed).
"""
