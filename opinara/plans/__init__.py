"""Named queries over the given tables, each with its SQL oracle where one exists."""
