"""Training-data operators: packing, ordering, dedup, quality, secrets, scoring, tokenising.

Nothing else in the library imports this subpackage; the driver entry adds
its queries only when it can be imported.
"""
