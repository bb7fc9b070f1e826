"""Reading raw extracts, writing curated and published datasets."""
