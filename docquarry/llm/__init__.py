"""Training-data operators: counting, searching, packing, cleaning and mixing a corpus."""
