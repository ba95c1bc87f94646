"""Training-data operators: deduplication, packing, scoring, tokenisation.

Nothing outside this folder imports it; the driver entry adds its queries only
when the folder is present.
"""
