"""presslake: a PySpark toolkit for building and analysing news-article archives."""
