"""Column helpers.  Every function takes and returns ``Column`` expressions."""
