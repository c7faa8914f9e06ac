"""Reading and writing ticks, tables, messages and file listings."""
