"""plans of cohortloom."""
