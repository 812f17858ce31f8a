"""Reading and writing logs, state, constants, reports and models."""
