"""Corpus operators for language-model training data (documents, pages, benchmark).

Nothing else in the library imports this subpackage; ``__spark_entry__.py`` adds
its queries when it is present.
"""
