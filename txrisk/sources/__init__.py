"""Reading and writing transactions, messages and predictions."""
