"""Reading labelled tables and named datasets; writing results."""
