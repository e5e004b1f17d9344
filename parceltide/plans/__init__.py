"""Named queries and the table store they run on."""
