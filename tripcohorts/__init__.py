"""Cohort comparisons over trip payment records, as composable Spark DataFrame functions."""
