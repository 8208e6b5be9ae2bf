"""Named queries over the driver's tables, each with its SQL statement where SQL can say it."""
