"""Operators for preparing text corpora: one module each; nothing outside this folder imports it."""
