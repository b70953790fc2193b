"""Training-data operators and their queries (see README, "Training-data
operators"). Nothing outside this folder imports it, except the guarded
registration in ``__spark_entry__`` and ``corpus_pipeline``."""
