"""Fitted transforms: ``fit`` learns a small state, ``transform`` applies it to any frame."""
