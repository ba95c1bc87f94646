"""DataFrame -> DataFrame operators: normalisation, quality, dedup, gold, profiling, maintenance."""
