"""Structured Streaming forms of the folds in operators.ledger."""
