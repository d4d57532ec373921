"""Operators for preparing language-model training data at corpus scale.

Nothing else in the library imports this subpackage; ``__spark_entry__`` adds
its queries only where it is present.
"""
