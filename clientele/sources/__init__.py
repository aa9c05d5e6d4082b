"""Inputs and outputs: ledger tables, model registry, prediction batches and table."""
