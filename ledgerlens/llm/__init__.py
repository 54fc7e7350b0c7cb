"""Corpus preparation for language-model training: ten operators on document tables and a pipeline over five of them."""
