"""Training-data operators: near-duplicate removal, quality scoring, decontamination, tokenisation.

Nothing outside this subpackage imports it; the rest of the library works when the folder is absent.
"""
