"""Column helpers and session helpers shared by the operators."""
