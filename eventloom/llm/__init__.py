"""Training-data operators: filters, classifiers, de-duplication, packing, search and text extraction.

Each module holds one operator over DataFrames; ``catalog`` holds their registered queries. Nothing
outside this folder imports it.
"""
