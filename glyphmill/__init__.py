"""glyphmill: a PySpark engine for building and analysing long-text corpora."""
