"""Training-data operators: one module per operator, registered queries in ``queries``.

Nothing else in the library imports this package; ``corpus_pipeline.py`` chains five of its operators.
"""
