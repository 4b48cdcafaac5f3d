"""Locuswise: sequencing reads, variants, genotypes and intervals as Spark DataFrames."""
