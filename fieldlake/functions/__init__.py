"""Column functions: expressions over columns, no DataFrame in sight."""
