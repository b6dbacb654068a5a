"""Operators for training-data pipelines over a ``documents`` table.

Each module holds one operator as a function from DataFrames to a DataFrame;
:mod:`logonlens.llm.queries` binds them to the tables with production parameters.
Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
