"""Training-data operators: secret scans, benchmark decontamination, SimHash
near-duplicates, line deduplication, exact inner-product search, HTML main
text, language identification, SentencePiece sampling, toxicity, URL filters,
quality scores, embedding whitening and hard-negative mining.  Nothing outside this package imports it; ``queries`` holds the
registered queries and their oracle SQL."""
