"""Writers: the table store and text files."""
