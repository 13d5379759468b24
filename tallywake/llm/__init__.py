"""Operators for training-data pipelines over a table of documents.

Every operator is a function from DataFrame to DataFrame. Unless an operator says otherwise: a null text counts
as an empty one, rows equal in doc_id and text are one document and get equal results, further columns are kept
apart by working on own column names, and an empty table gives an empty result of the same columns.
"""
