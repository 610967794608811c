"""Triage assembled from the operators, its report and the batch job."""
