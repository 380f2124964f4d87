"""Stored state that batches are folded into, each of them once."""
