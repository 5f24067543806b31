"""Training-data operators: deduplication, filtering, models, packing and file formats.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames; Python runs only inside tasks, on Arrow batches.
"""
