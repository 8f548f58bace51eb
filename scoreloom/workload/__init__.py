"""The benchmark tables read as match documents, the registered queries and their SQL."""
