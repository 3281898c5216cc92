"""Operators of a training-data pipeline, each a set of Spark jobs.

=====================  ====================================================
``embedding_dedup``    near-duplicate vectors by rotated binary codes
``piece_transducer``   SentencePiece encoding and decoding by a transducer
``ngram_join``         word-shingle Jaccard join over size-banded tiles
``chat``               maximal conversations, rendered
``decontamination``    benchmark passages by item-sized SimHash windows
``url_rules``          host and path rules by hashed expressions
``language_id``        nearest centroid over character n-grams
``html_wrapper``       main text by wrapper induction
``pii``                personal data and the terms that disclose it
``passages``           repeated fuzzy passages by collinear chaining
``divergence``         sources compared by a quadtree over their term counts
``infill``             fill-in-middle over seekable compressed frames
``warc``               archives written, read and assembled to captures
=====================  ====================================================

Nothing outside this package imports it; ``queries`` registers its queries.
"""
