"""Readers for transactions and archived stages."""
