"""Spark operators for published official statistics."""
