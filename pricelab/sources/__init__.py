"""Typed reads, prediction tables, fold files, result tables."""
