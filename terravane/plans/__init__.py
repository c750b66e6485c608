"""Dataset cleaning plans, marts and reports composed from the operators."""
