"""Training-data operators (ten dealt operators, see README "llm").

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports
it.
"""
