"""streaming of cohortloom."""
