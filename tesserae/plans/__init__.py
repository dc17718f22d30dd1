"""Named queries over the driver's tables, each beside the SQL that it is checked against."""
