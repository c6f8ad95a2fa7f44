"""Readmission analytics on Spark: features, labels, balancing, forests and
data-quality studies as DataFrame functions."""
