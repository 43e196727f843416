"""Readers and writers: raw CSV files, the driver's event table, written layers,
dashboard exports and the case-note store."""
