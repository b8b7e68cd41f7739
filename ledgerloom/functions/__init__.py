"""Column functions: no session, no input or output."""
