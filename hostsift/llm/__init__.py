"""Training-data operators: deduplication, tokenising, classifiers, packing, scans.

Nothing else in the package imports this subpackage.
"""
