"""Training-data operators: extraction, labelling, deduplication, tokenising and packing of text.

Nothing outside this subpackage imports it.
"""
