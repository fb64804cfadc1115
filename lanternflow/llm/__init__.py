"""Training-data operators: mixing, language ID, URL filters, search, decontamination,
secrets, near-duplicates, WARC, token files and licence scans.

Nothing else in the library imports this subpackage.
"""
