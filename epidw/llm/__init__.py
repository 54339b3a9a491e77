"""Operators for preparing training text, each on Spark data frames of documents or turns."""
