"""Schema-independent DataFrame operators."""
