"""Tenant-scoped subsetting, anonymization, validation and publishing on Spark."""
