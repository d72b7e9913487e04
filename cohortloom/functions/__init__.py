"""functions of cohortloom."""
