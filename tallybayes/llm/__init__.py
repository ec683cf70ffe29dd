"""Operators of a training-data pipeline, one module each.

Nothing else in the library imports this subpackage. ``queries`` registers one
``opN_<name>`` query per operator; ``/corpus_pipeline.py`` chains five of them.
"""
