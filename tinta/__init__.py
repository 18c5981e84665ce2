"""tinta: text-corpus, subword and embedding analytics as PySpark DataFrame operators."""
