"""cohortloom: a PySpark library for explainable, peer-relative anomaly detection on entity x month panels."""
