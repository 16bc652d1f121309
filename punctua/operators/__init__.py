"""DataFrame operators. Each takes and returns DataFrames; nothing runs until an action."""
