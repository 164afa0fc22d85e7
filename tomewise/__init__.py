"""Analytics over large collections of books, written as PySpark DataFrame jobs."""
