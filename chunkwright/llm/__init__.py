"""Training-data operators: mixing, LM scoring, line / exact / near / substring
de-duplication, quality rules, language ID, BPE (by words and by chunks),
sharding, embedding whitening and periodic runs.

Nothing else in the library imports this subpackage. Each module holds one
operator with its general interface; ``entries`` derives the registered
``opN_<name>`` queries (digest columns) from them.
"""
