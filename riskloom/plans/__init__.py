"""The composed tables: payment index, AML indexes, marketplace orders."""
