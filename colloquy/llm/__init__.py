"""Training-data operators for large text corpora.

Nothing outside this subpackage imports it; see :mod:`colloquy.llm.queries` for the registered queries.
"""
