"""Operators for training and evaluation data of language models."""
