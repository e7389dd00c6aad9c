"""Training-data operators: quality rules, de-duplication, tokenizing, packing, ...

Self-contained: nothing else in the library imports this subpackage.
"""
