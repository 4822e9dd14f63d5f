"""Blending and weight search over many models' predictions."""
