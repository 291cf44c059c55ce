"""Training-data operators: decontamination, toxicity, line dedup, PII, WARC,
license scans, source mixing, quality classifier, n-gram join, quality rules,
hard-negative mining, spelling variants, exact dedup.

Nothing else in the library imports this subpackage.
"""
