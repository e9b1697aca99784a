"""Incremental variants of the lead loads."""
