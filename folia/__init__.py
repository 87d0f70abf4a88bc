"""Set-at-a-time document-structure analytics on PySpark."""
