"""Operators for training data: filters, de-duplication, decontamination, packing, sharding."""
