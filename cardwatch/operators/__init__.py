"""DataFrame -> DataFrame operators (no writes, no actions except the
documented size check and key guard)."""

from cardwatch.operators import chain, history, keys, rules, sequences, sizing

__all__ = ["chain", "history", "keys", "rules", "sequences", "sizing"]
