"""Operators over text collections: each lives in a module of its own, ``catalogue`` registers them."""
