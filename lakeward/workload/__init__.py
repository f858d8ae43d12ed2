"""The registered queries: feeds derived from the given tables, and the SQL each result must equal."""
