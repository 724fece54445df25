"""Column expressions shared by the operators."""

from ridgeway.functions.digest import key_digest, key_word
from ridgeway.functions.linear import dot, linear_column

__all__ = ["dot", "key_digest", "key_word", "linear_column"]
