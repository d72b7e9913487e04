"""sources of cohortloom."""
