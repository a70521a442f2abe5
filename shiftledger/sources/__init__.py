"""Reading extracts, destination records and stored tables; staging and publishing."""
