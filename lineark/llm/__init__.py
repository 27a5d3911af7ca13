"""Operators for preparing training text: one module per operator, each a plain
function from DataFrame(s) to a DataFrame.  ``queries`` applies them to the given
tables.  Nothing outside this subpackage imports it."""
