"""Operators for training-data pipelines: toxicity, licences, decontamination,
token counts, near-duplicates, mixing, quality, chunk dedup, nearest
neighbours, suffix dedup, main text of pages, ranked search and hard
negatives.  Nothing else in the package imports this subpackage."""
