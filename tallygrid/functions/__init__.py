"""Column functions: no function here starts a job."""
