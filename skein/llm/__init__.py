"""Training-data operators: ten corpus-scale building blocks, each in a module of its own.

Nothing outside this subpackage imports it.  ``queries.py`` holds the thin ``opN_*`` queries.
"""
