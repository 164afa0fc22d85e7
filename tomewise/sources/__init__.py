from tomewise.sources.documents import book_view, documents
from tomewise.sources.text_files import (
    file_name,
    read_books,
    read_lines,
    require_unique,
    require_unique_names,
    split_size,
)

__all__ = [
    "book_view",
    "documents",
    "file_name",
    "read_books",
    "read_lines",
    "require_unique",
    "require_unique_names",
    "split_size",
]
