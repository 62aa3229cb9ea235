"""Training-data operators: secrets, byte-level BPE, media columns, similarity join, token counts,
packing, chat formatting, language identification, repeated passages and quality rules.

Nothing outside this package imports it. Vocabulary files are parameters and never part of the library.
"""
