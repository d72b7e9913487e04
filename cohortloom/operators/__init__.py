"""operators of cohortloom."""
