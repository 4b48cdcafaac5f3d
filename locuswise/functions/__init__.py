"""Column builders: sequence, quality, cigar, flag, allele, codon and statistics expressions."""
