"""Production-incident triage as Spark DataFrame operators."""
