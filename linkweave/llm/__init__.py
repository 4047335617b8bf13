"""Operators that prepare text for training language models; nothing else here imports them."""
