"""Training-data operators: dedup, sketches, language ID, chat formatting, URL
filters, language-model scoring, packing, mixing, fill-in-the-middle and vector
codes.

Each operator is one module with a general interface (any id and text column,
extra columns pass through); ``queries`` binds the operators to the test
tables. Nothing else in the library imports this package.
"""
