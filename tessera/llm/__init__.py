"""Training-data operators: packing, nearest neighbours, license scans, URL filters,
near-duplicates, quality rules, language ID, passage and line dedup, BPE,
centroid clustering, importance resampling, exact top-k search.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries
only when it can be imported.
"""
