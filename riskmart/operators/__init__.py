"""DataFrame -> DataFrame jobs, one module per pipeline stage."""
