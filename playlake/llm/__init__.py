"""Operators for preparing training data, each by a named method.

``quality_llr`` (quality rules), ``near_dup`` (MinHash near-dedup), ``pii_boost``
(personal data), ``byte_dedup`` (suffix-array dedup), ``packing``,
``lang_filter`` (language identification), ``mixing`` (target weights), ``chat``
(chat formatting), ``fingerprint`` (document fingerprints), ``word_dedup``
(substring dedup), ``byte_bpe`` (byte-level BPE), ``whitening`` (embedding
whitening) and ``hard_negatives`` (hard-negative mining). ``queries`` registers one query for each.

Nothing outside this folder imports from it but ``corpus_pipeline.py`` and the
guarded import in ``__spark_entry__.py``.
"""
