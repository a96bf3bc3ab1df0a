"""Operators that prepare text for training language models, over documents and conversations."""
