"""Training-data operators: ten document, page and vector operators for corpus preparation.

Nothing else in the library imports this subpackage.  Each module holds one
operator with its own general interface; ``queries`` registers one thin query
per operator (``opN_<name>``) that applies it to a whole table.
"""
