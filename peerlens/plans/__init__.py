"""Named queries over the project's tables and the SQL that checks them."""
