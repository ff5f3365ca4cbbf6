"""Training-data operators: scoring, deduplication, tokenising, search and packing.

One module per operator; ``queries`` registers the thin ``opN_<name>`` queries.
Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
