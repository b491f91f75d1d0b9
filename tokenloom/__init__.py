"""tokenloom: text-corpus tokenization and next-token modelling as Spark jobs.

Subpackages:
  functions  column-level expressions (pretokenizing, hex symbols, vector math)
  sources    readers and writers (delimited corpora, token streams, tokenizer tables)
  operators  DataFrame -> DataFrame operators (BPE training, codec, windows, model)
  streaming  Structured Streaming forms of the encoder and the piece counter
  plans      the registered queries and their DuckDB oracle SQL
"""

from tokenloom.session import build_session, checkpoint_dir, cut_lineage

__all__ = ["build_session", "checkpoint_dir", "cut_lineage"]
