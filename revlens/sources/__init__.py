from revlens.sources.tables import TABLES, labelled_reviews, read_table, reviews  # noqa: F401
