"""The operators bound to the transaction-attempt model."""
