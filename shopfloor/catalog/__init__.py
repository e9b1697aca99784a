"""The registered queries, their inputs taken from the star-schema tables, and their SQL."""
