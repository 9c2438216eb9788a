"""Column functions.  All of them stay inside Catalyst."""
