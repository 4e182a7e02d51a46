"""Reading and writing; the only modules with side effects."""
