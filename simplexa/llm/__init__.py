"""Operators for training-data pipelines: sharding, token counts, packing, fingerprints, joins and filters on text.

Nothing else in the library imports this package.  Tables are `documents` (doc_id, text, ...); every operator accepts
null ids and texts, empty tables, repeated rows and further columns, as its docstring says.
"""
