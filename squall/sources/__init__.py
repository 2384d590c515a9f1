"""Reading and writing observations."""
