"""Observation ledger for medical-image metadata, as PySpark DataFrame operators."""
